"""Alignment in pieces against the uncut alignment."""

import random

import pytest

from callweave.functions.alignment import edit_script, matching_blocks
from callweave.operators.piecewise import edit_scripts, pieces


def heard(words, draw, rate):
    out = []
    for w in words:
        x = draw.random()
        out += [] if x < rate / 3 else [w, w] if x < rate * 2 / 3 else [draw.choice("xyz")] if x < rate else [w]
    return out


def cases():
    draw = random.Random(5)
    out = []
    for n, letters in ((0, 3), (1, 3), (40, 3), (300, 4), (900, 2000), (4000, 300)):
        for rate in (0.0, 0.05, 0.3):
            ref = [f"w{draw.randrange(letters)}" for _ in range(n)]
            out.append((len(out), ref, heard(ref, draw, rate)))
    ref = [f"v{i}" for i in range(800)]
    out.append((len(out), ref, ref[500:] + ref[:500]))  # a moved half
    out.append((len(out), ["a"] * 700, ["a"] * 650))  # one word over and over
    out.append((len(out), ["a", "b"], []))
    return out


@pytest.mark.parametrize("gram,most", [(5, 16), (3, 4), (2, 1000)])
def test_equal_to_the_uncut_result(spark, gram, most):
    rows = [c for c in cases() if gram > 2 or len(c[1]) < 500]
    pairs = spark.createDataFrame(rows, "call_id int, ref array<string>, hyp array<string>")
    got: dict = {}
    for r in sorted(edit_scripts(pairs, gram, most).collect(), key=lambda r: (r.call_id, r.op_no)):
        got.setdefault(r.call_id, []).append(r)
    for call_id, ref, hyp in rows:
        want = edit_script(matching_blocks(ref, hyp), len(ref), len(hyp))
        mine = got.get(call_id, [])
        assert [(r.tag, r.i1, r.i2, r.j1, r.j2) for r in mine] == want, call_id
        assert [r.op_no for r in mine] == list(range(len(want)))
        for r in mine:
            assert r.ref_words == ref[r.i1 : r.i2] and r.hyp_words == hyp[r.j1 : r.j2]
            assert r.context == (" ".join(ref[max(0, r.i1 - 3) : r.i2 + 3]) if r.tag == "replace" else None)


def test_a_long_call_is_many_pieces(spark):
    draw = random.Random(1)
    ref = [f"w{draw.randrange(500)}" for _ in range(20_000)]
    pairs = spark.createDataFrame([(1, ref, heard(ref, draw, 0.05))], "call_id int, ref array<string>, hyp array<string>")
    found = pieces(pairs).where("NOT run").selectExpr("size(ref_words) AS n").collect()
    assert len(found) > 300 and max(r.n for r in found) < 200


def test_deficits_are_found_once(spark):
    """The sort reads stored rows: its sampling does not go back to the orders."""
    from callweave.plans import scoring

    out = scoring.entity_deficits(spark, "/root/testdata/sf0.001")
    assert out.inputFiles() and not any("orders" in f for f in out.inputFiles())
    found = [r.deficit for r in out.collect()]
    assert found and found == sorted(found, reverse=True)
