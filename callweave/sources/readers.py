"""File and table readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave import schemas


def csv_dimension(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """Headed CSV with quoted line breaks; texts trimmed, rows without a key dropped."""
    rows = spark.read.csv(path, schema=schema, header=True, multiLine=True, quote='"', escape='"')
    texts = [c for c, t in rows.dtypes if t == "string"]
    return rows.withColumns({c: F.trim(c) for c in texts}).where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Transcript documents of both generations: root segments, else those of the sections in order."""
    docs = spark.read.schema(schemas.TRANSCRIPT).json(path, multiLine=True, mode="PERMISSIVE")
    return docs.withColumn("segments", F.coalesce("segments", F.flatten(F.transform("sections", lambda s: s["segments"]))))


def transcript_segments(docs: DataFrame) -> DataFrame:
    """One row per segment with its section and position."""
    rows = docs.select("event_id", "ticker", "fiscal_period", F.posexplode("sections").alias("_s", "sec"))
    return rows.select("event_id", "ticker", "fiscal_period", "_s", F.col("sec.type").alias("section"), F.posexplode("sec.segments").alias("pos", "seg")).select(
        "event_id", "ticker", "fiscal_period", "section", "_s", "pos", "seg.*")


def quarantined(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, bad) documents of a folder of JSON: good ones as declared; of the others the file, why they are kept out, and their text.

    A document is bad where the parser gives it up or where none of the declared fields is there. ``schema`` has a _corrupt_record column."""
    rows = spark.read.schema(schema).json(path, multiLine=multi_line, mode="PERMISSIVE").withColumn("_file", F.col("_metadata.file_path"))
    # The parser fills the corrupt record only where the whole schema is read, so rows are taken as they are before they are told apart.
    names = [c for c in rows.columns if c not in ("_corrupt_record", "_file")]
    empty = ~F.exists(F.array(*[F.col(c).isNotNull() for c in names]), lambda there: there)
    why = F.when(F.col("_corrupt_record").isNotNull(), "unreadable").when(empty, "no declared field")
    told = rows.select("*", F.explode(F.array(F.struct(why.alias("why")))).alias("_q"))
    good = told.where(F.col("_q.why").isNull()).select(*names)
    bad = told.where(F.col("_q.why").isNotNull()).select(F.col("_file").alias("file"), F.col("_q.why").alias("reason"), F.col("_corrupt_record").alias("document"))
    return good, bad


def call_metrics(spark: SparkSession, path: str, calls: DataFrame | None = None) -> DataFrame:
    """Call metrics documents; with a (call_key, ord) list, in its order and with ``missing`` marking absent documents."""
    docs = spark.read.schema(schemas.CALL_METRICS).json(path, multiLine=True, mode="PERMISSIVE")
    docs = docs.withColumn("call_key", F.concat_ws("_", "ticker", F.replace("fiscal_period", F.lit(" "), F.lit("_"))))
    if calls is None:
        return docs
    return calls.join(docs, "call_key", "left").withColumn("missing", F.col("ticker").isNull()).orderBy("ord")


def whole_texts(spark: SparkSession, path: str, call: str = r"([^/]+)\.txt$") -> DataFrame:
    """One text per file; the call id comes from the file name."""
    rows = spark.read.text(path, wholetext=True).withColumn("_file", F.col("_metadata.file_path"))
    return rows.select(F.regexp_extract("_file", call, 1).alias("call_id"), F.col("value").alias("text"))


def engine_outputs(spark: SparkSession, path: str) -> DataFrame:
    """Lines of engine output files ``<library>_<device>_<clip>.txt`` with optional ``[start --> end]`` stamps."""
    stamp = r"^\s*\[\s*([\d.]+)\s*-->\s*([\d.]+)\s*\]\s*"
    rows = spark.read.text(path).withColumn("_file", F.col("_metadata.file_name")).withColumn("_id", F.monotonically_increasing_id())
    name = lambda i: F.regexp_extract("_file", r"^(.*?)_(cpu|cuda|gpu)_(.*)\.txt$", i)
    number = lambda i: F.try_to_number(F.nullif(F.regexp_extract("value", stamp, i), F.lit("")), F.lit("999999999.999")).cast("double")
    return rows.select(
        name(1).alias("library"), name(2).alias("device"), name(3).alias("clip"), F.col("_id").alias("line_no"),
        number(1).alias("start"), number(2).alias("end"), F.regexp_replace("value", stamp, "").alias("text"))


def failure_log(spark: SparkSession, path: str) -> DataFrame:
    """"ticker, url, reason" lines; the reason may hold commas."""
    parts = F.split(F.trim("value"), ", ", 3)
    return spark.read.text(path).where(F.trim("value") != "").select(
        F.get(parts, F.lit(0)).alias("ticker"), F.get(parts, F.lit(1)).alias("url"), F.get(parts, F.lit(2)).alias("reason"))


def cached_pages(spark: SparkSession, path: str) -> DataFrame:
    """Cached responses keyed by the hash in their file name."""
    rows = spark.read.schema(schemas.CACHED_PAGE).json(path, multiLine=True).withColumn("_file", F.col("_metadata.file_name"))
    return rows.select(F.regexp_extract("_file", r"^([0-9a-f]+)", 1).alias("cache_key"), "status_code", "text")


def submissions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SUBMISSIONS).json(path, multiLine=True)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def database_table(spark: SparkSession, url: str, name: str, split_on: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """Relational table read in parallel ranges of a numeric column."""
    return spark.read.jdbc(url, name, column=split_on, lowerBound=low, upperBound=high, numPartitions=parts, properties=options)


def _number(content: Column, at: Column, size: int) -> Column:
    """Unsigned little-endian number of the bytes from place ``at`` (0-based)."""
    text = F.hex(F.substring(content, at + 1, F.lit(size)))
    return F.conv(F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(size))]), 16, 10).cast("long")


def riff_chunks(content: Column) -> Column:
    """Places and lengths of the fmt and data chunks of a RIFF WAVE file as (fmt_at, fmt_size, data_size); null where the file is none or lacks one.

    The chain of chunks is walked: each says how long it is, odd lengths are padded, others (LIST, fact, JUNK, ...) are passed over."""
    def tag(at: Column) -> Column:
        return F.decode(F.substring(content, at + 1, F.lit(4)), "ISO-8859-1")

    def step(state: Column, _: Column) -> Column:
        at = state["at"]
        size = _number(content, at + 4, 4)
        inside = at + 8 <= F.octet_length(content)
        fmt = inside & (tag(at) == "fmt ") & state["fmt_at"].isNull()
        data = inside & (tag(at) == "data") & state["data_size"].isNull()
        moved = F.when(inside & state["data_size"].isNull() & ~data, at + 8 + size + size % 2).otherwise(at)
        return F.struct(
            moved.cast("int").alias("at"), F.when(fmt, at + 8).otherwise(state["fmt_at"]).alias("fmt_at"),
            F.when(fmt, size).otherwise(state["fmt_size"]).alias("fmt_size"), F.when(data, size).otherwise(state["data_size"]).alias("data_size"))

    # No file has more chunks than an eighth of its bytes; the walk stays where it is once the data chunk is found.
    none = F.struct(F.lit(12).alias("at"), F.lit(None).cast("int").alias("fmt_at"), F.lit(None).cast("long").alias("fmt_size"), F.lit(None).cast("long").alias("data_size"))
    turns = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.octet_length(content) / 8, F.lit(CHAIN)).cast("int")))
    is_wave = (F.decode(F.substring(content, 1, 4), "ISO-8859-1") == "RIFF") & (F.decode(F.substring(content, 9, 4), "ISO-8859-1") == "WAVE")
    found = F.when(is_wave, F.aggregate(turns, none, step))
    return F.when(found["fmt_at"].isNotNull() & found["data_size"].isNotNull(), found)


#: Chunks ahead of the audio data that are walked over; a file with more has no facts, as a broken one.
CHAIN = 256


def audio_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Size, SHA-256 and header facts of WAV files, whatever chunks stand ahead of the data.  ``canonical`` is true for the plain 44-byte header;
    ``encoding`` is the format's number (of an extensible format, its sub-format).  A file without a fmt and a data chunk has null facts."""
    files = spark.read.format("binaryFile").load(path)
    rows = files.select(
        F.col("path"), F.regexp_extract("path", r"([^/]+)\.wav$", 1).alias("stem"), F.col("length").alias("file_size"),
        F.sha2("content", 256).alias("sha256"), F.col("content").alias("_c"))
    rows = rows.select("*", F.explode(F.array(riff_chunks(F.col("_c")))).alias("_r"))
    fact = lambda offset, size: F.when(F.col("_r").isNotNull(), _number(F.col("_c"), F.col("_r.fmt_at") + offset, size))
    code = fact(0, 2)
    rows = rows.select(
        "path", "stem", "file_size", "sha256",
        F.coalesce((F.col("_r.fmt_at") == 20) & (F.col("_r.fmt_size") == 16) & (F.decode(F.substring("_c", 37, 4), "ISO-8859-1") == "data"), F.lit(False)).alias("canonical"),
        fact(4, 4).alias("sample_rate"), fact(2, 2).alias("channels"), fact(14, 2).alias("bit_depth"),
        F.when((code == 0xFFFE) & (F.col("_r.fmt_size") >= 40), fact(24, 2)).otherwise(code).alias("encoding"), F.col("_r.data_size").alias("_bytes"))
    rate = F.col("sample_rate") * F.col("channels") * F.col("bit_depth") / 8
    return rows.withColumn("duration_sec", F.col("_bytes") / F.nullif(rate, F.lit(0.0))).drop("_bytes")
