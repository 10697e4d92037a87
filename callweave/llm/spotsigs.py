"""Operator 9: document fingerprints from spot signatures, on DataFrame functions only.

Common words of a text are anchors. Each anchor starts a signature: the anchor and the chain of the next two content words, other common words
between them left out. Of several anchors in a row the last one counts. The start of the text is an anchor as well, so a text with any word has
a signature. A fingerprint is the sorted set of the 64-bit hashes of a text's signatures; texts are lower-cased, words are letters and digits.

Likeness of two fingerprints is the Jaccard share of their sets; two fingerprints without signatures are alike (1), one against none is not (0).
`matches` finds all pairs of fingerprints at a threshold: sets are partitioned by length so that only a partition and the next can be
similar, indexed under their rarest signatures up to the length that the threshold needs, and compared in full only where the bound still holds.

Null texts are empty. Null ids come last in the order of ids. Rows that repeat an id and a text count once in that order and all get its
result; equal ids with different texts are ordered by text hash. A single document's next document is itself. An empty table gives an empty
table. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callweave.llm import common

#: Common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was were which with "
    "you au aux ce ces dans de des du elle en est et il la le les leur mais ne ou par pas pour que qui sa se ses son sont sur un une "
    "aber als am auch auf aus bei bin das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit nach nicht sich sie "
    "sind so und von vor war wie zu zum zur al como con del el era las lo los más no para pero por su sus una y"
)
#: Shortest list of index entries per set keeps a pair of similar sets together only up to this likeness.
THRESHOLD = 0.8


def _any_of(words: set[str]) -> str:
    """A pattern for any of the words, branched by first letter so that few are tried at a place."""
    heads = sorted({w[0] for w in words})
    return "|".join(f"{h}(?:{'|'.join(sorted((w[1:] for w in words if w[0] == h), key=len, reverse=True))})" for h in heads)


def signatures(text: Column) -> Column:
    """Sorted distinct signature hashes of a text."""
    words = F.concat(F.lit(" |^ "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    words = F.replace(words, F.lit("  "), F.lit(" "))
    marked = F.regexp_replace(words, f" ({_any_of(set(ANCHORS.split()))})(?= )", " |$1")
    # An anchor that another one follows goes; the last one is tied to the word after it.
    last = F.regexp_replace(marked, r"\|[^ |]+ (?=\|)", "")
    tied = F.split(F.trim(F.regexp_replace(last, r"\|([^ ]+) ", "$1|")), " ")

    def spots(t: Column) -> Column:
        after = F.slice(F.concat(t, F.array(F.lit(""))), F.lit(2), F.size(t))
        return F.array_compact(F.zip_with(t, after, lambda x, y: F.when(F.contains(x, F.lit("|")), F.xxhash64(x, F.substring_index(y, "|", -1)))))

    # The one-element transform evaluates the words once, though `spots` names them three times.
    found = F.sort_array(F.array_distinct(F.flatten(F.transform(F.array(tied), spots))))
    return F.when(F.rlike(text, F.lit(r"[\p{L}\p{N}]")), found).otherwise(F.array().cast("array<long>"))


def shown(signs: Column) -> Column:
    return F.array_join(signs.cast("array<string>"), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard share of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(a) + F.size(b) - both)).cast("double")


def fingerprints(docs: DataFrame, text: str = "text", out: str = "signatures") -> DataFrame:
    return docs.withColumn(out, signatures(common.whole(F.col(text))))


def matches(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b, likeness of all pairs of different sets that reach the threshold; sets are named by their hash. `members` gives the rows of a set."""
    sets = common.written(members(prints).select("set", "signatures").where(F.size("signatures") > 0).groupBy("set").agg(F.first("signatures").alias("signatures")))
    each = sets.select("set", F.size("signatures").alias("n"), F.explode("signatures").alias("sign"))
    times = each.groupBy("sign").agg(F.count(F.lit(1)).alias("times"))
    order = Window.partitionBy("set").orderBy("times", "sign")
    ranked = each.join(times, "sign").withColumn("rank", F.row_number().over(order))
    # Similar sets share one of their n - ceil(t n) + 1 rarest signatures, and their lengths differ by the factor t at most.
    kept = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).drop("times")
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(-1.0) / F.log(F.lit(threshold)))
    kept = kept.withColumn("part", part)
    probe = kept.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("rank").alias("ra"), "sign", F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"))
    base = kept.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("rank").alias("rb"), "sign", "part")
    # Longer against shorter sets; after ranks ra and rb only so many signatures can still be common.
    most = 1 + F.least(F.col("na") - F.col("ra"), F.col("nb") - F.col("rb")) + F.least("ra", "rb") - 1
    bound = most >= threshold / (1 + threshold) * (F.col("na") + F.col("nb")) - 1e-9
    ahead = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") > F.col("b")))
    pairs = probe.join(base, ["part", "sign"]).where(ahead & bound & (F.col("nb") >= F.col("na") * threshold - 1e-9)).select("a", "b").distinct()
    left = sets.select(F.col("set").alias("a"), F.col("signatures").alias("sa"))
    right = sets.select(F.col("set").alias("b"), F.col("signatures").alias("sb"))
    scored = pairs.join(left, "a").join(right, "b").withColumn("likeness", likeness(F.col("sa"), F.col("sb")))
    return scored.where(F.col("likeness") >= threshold - 1e-12).select("a", "b", "likeness")


def members(prints: DataFrame) -> DataFrame:
    """Adds `set`, the hash of a row's signature set."""
    return prints.withColumn("set", F.xxhash64("signatures"))


def neighbours(keys: DataFrame) -> DataFrame:
    """For distinct (doc_id, mark) with n and copies: the next row in descending order of ids, and the first row after the last one.

    Rows are range-partitioned; the next row is found inside a range, at its end from one row per range.
    """
    down = [F.col("doc_id").desc_nulls_last(), F.col("mark")]
    ranged = keys.repartitionByRange(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), *down)
    ranged = common.written(ranged.withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("range").orderBy(*down)
    me = F.struct("doc_id", "mark", "copies")
    rows = ranged.withColumn("next", F.lead(me).over(inside)).withColumn("place", F.row_number().over(inside))
    # One row per range: its first document. Ranges are as many as shuffle partitions.
    heads = rows.where("place = 1").select("range", me.alias("head"))
    over = Window.orderBy("range")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = heads.select("range", F.coalesce(F.lead("head").over(over), F.first("head").over(whole)).alias("follow"))
    return common.written(rows.join(follow, "range").withColumn("next", F.coalesce("next", "follow")).select("doc_id", "mark", "n", "next"))


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, text, edited, next_text: the last half of a text replaced by the beginning of the next document's.

    Texts move twice: to their key, and from there to the key of the document ahead; both branches read the first exchange.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(name.alias("id"), common.whole(F.col("text")).alias("text"), "doc_id").withColumn("mark", F.xxhash64("text"))
    keys = rows.groupBy("doc_id", "mark").agg(F.first(F.char_length("text").cast("long")).alias("n"), F.count(F.lit(1)).alias("copies"))
    links = neighbours(keys.select("doc_id", "mark", "n", "copies"))
    mine = links.select(name.alias("id"), "mark", "doc_id", F.col("n").alias("n_chars"))
    ahead = links.select(
        F.coalesce(F.col("next.doc_id").cast("string"), F.lit("null")).alias("id"), F.col("next.mark").alias("mark"), F.col("next.copies").alias("copies"),
        name.alias("to_id"), F.col("mark").alias("to_mark"),
    )
    texts = rows.select("id", "mark", "text")
    sent = texts.join(ahead, ["id", "mark"]).select(F.col("to_id").alias("id"), F.col("to_mark").alias("mark"), F.col("text").alias("next_text"), "copies")
    # Of repeated rows one is sent.
    sent = sent.where("copies = 1").unionByName(sent.where("copies > 1").dropDuplicates(["id", "mark"])).drop("copies")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    mixed = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half))
    return texts.join(mine, ["id", "mark"]).join(sent, ["id", "mark"]).select("doc_id", "n_chars", "text", mixed.alias("edited"), "next_text")


def op9_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    rows = edited(common.table(spark, folder, "documents"))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *(signatures(F.col(c)).alias(s) for c, s in (("text", "own"), ("edited", "mixed"), ("next_text", "next"))))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", shown(F.col("own")).alias("fingerprint"), shown(F.col("mixed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("mixed")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


QUERIES = {"op9_spotsigs": op9_spotsigs}
ORACLE: dict[str, str] = {}
