"""Findings of the fourth round."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from callweave.functions import editdist, manypairs
from callweave.functions.editdist import edit_distance
from callweave.llm import components
from callweave.plans import streams


def test_backlog_of_calls_past_the_year_2262(spark):
    """Call numbers from some 2.5 million on have times that Python's nanoseconds do not reach; also where their rows come in several batches."""
    rows = [(c, k, 50.0 + k, 45.0) for c in (2_500_000, 2_600_000, 2_600_001) for k in range(4)]
    chunks = spark.createDataFrame(rows, "call_id long, chunk_idx int, proc_time_sec double, duration_sec double")
    want = sorted((c, k, sum(range(k + 1)) + 5.0 * (k + 1)) for c, k, _, _ in rows)
    for files in (None, 3):
        got = streams.backlog_live(chunks, files).select("call_id", "chunk_idx", F.col("backlog_sec")).collect()
        assert sorted(map(tuple, got)) == want


def test_pairs_side_by_side():
    """Each pair as by itself, at block borders, in any script; all but a few of them in arrays."""
    draw = np.random.default_rng(5)
    a, b = [], []
    for k in range(900):
        letters = list(("ab", "abcdefghijklmno pqrstuvwxyz", "aé漢字😀b c")[k % 3])
        text = draw.choice(letters, draw.choice([0, 1, 30, 63, 64, 65, 127, 128, 129, 200, 300]))
        change = draw.random(len(text)) < draw.choice([0, 0.05, 0.2, 0.3, 0.8])
        a.append("".join(text))
        b.append("".join(x if not c else draw.choice(["", "b", x + "c"]) for x, c in zip(text, change)))
    distance = np.array([edit_distance(x, y) for x, y in zip(a, b)])
    single = []

    def one(x, y, limit):
        single.append(x)
        return edit_distance(x, y) <= limit

    for share in (0.05, 0.2, 0.5):
        limits = np.array([int(max(len(x), len(y)) * share) for x, y in zip(a, b)])
        single.clear()
        assert (manypairs.within(a, b, limits, one) == (distance <= limits)).all() and len(single) < 200


def test_least_common_key_of_a_chunk():
    """A pair belongs to its least common key: True where two lists share a smaller one."""
    draw = np.random.default_rng(1)
    x, y = ([sorted(map(int, draw.choice(40, draw.integers(0, 9), replace=False))) for _ in range(n)] for n in (30, 20))
    lists = [pa.array(z, pa.list_(pa.int64())) for z in (x, y)]
    want = [[any(k < 20 for k in set(p) & set(q)) for q in y] for p in x]
    assert components._sooner(*lists, 20).tolist() == want


def test_distances_of_many_pairs():
    """Texts and lists of words together as one by one; empty ones, equal ones, wide alphabets, and None past the budget or the most edits."""
    draw = np.random.default_rng(9)
    a, b = ["", "", "abc", "same text"], ["", "xy", "", "same text"]
    for k in range(300):
        letters = ("ab", "abcdefghijklm nopqrstuvwxyz", "aé漢字😀b c", "".join(map(chr, range(100, 900))))[k % 4]
        text = [letters[i] for i in draw.integers(0, len(letters), draw.choice([1, 7, 8, 9, 30, 100, 300]))]
        change = draw.random(len(text)) < draw.choice([0, 0.02, 0.1, 0.5, 1])
        a.append("".join(text))
        b.append("".join(x if not c else ("", "b", x + "c")[draw.integers(3)] for x, c in zip(text, change)))
    want = [edit_distance(x, y) for x, y in zip(a, b)]
    assert manypairs.distances(a, b, lambda n, m: 1e9) == want
    assert manypairs.distances([list(x) for x in a], [list(x) for x in b], lambda n, m: 1e9) == want
    some = manypairs.distances(a, b, lambda n, m: 6.0)
    assert all(g is None or g == w for g, w in zip(some, want)) and None in some
    assert manypairs.distances(["a" * 900], ["b" * 900], lambda n, m: 1e9) == [None]
    assert editdist.edit_distances([*a, "a" * 900], [*b, "b" * 900]) == [*want, 900]
