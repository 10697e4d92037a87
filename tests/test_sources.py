"""Readers and writers on small files."""

import json
import wave

from pyspark.sql import functions as F

from callweave.operators import quality as ql, reports as rp
from callweave import schemas
from callweave.sources import readers, writers

SEG = {"start": 0.0, "end": 10.0, "speaker_id": "S0", "speaker_name": None, "speaker_role": "Operator", "text": "Welcome.", "confidence": 0.95}


def test_manifest_with_line_breaks(spark, tmp_path):
    head = ",".join(c.split()[0] for c in schemas.MANIFEST.split(", "))
    (tmp_path / "m.csv").write_text(f'{head}\n7, ACME ,Q1 FY2026,a.wav,direct,,,12.5,16000,9,h,"failed:\n""quoted"", twice",u,,auto\n,,,,,,,,,,,,,,\n')
    rows = readers.csv_dimension(spark, str(tmp_path / "m.csv"), schemas.MANIFEST, "ticker").collect()
    assert len(rows) == 1 and rows[0].ticker == "ACME" and rows[0].failure_reason == 'failed:\n"quoted", twice'


def test_transcripts_of_both_generations(spark, tmp_path):
    sections = [{"type": "operator_intro", "start": 0.0, "end": 10.0, "segments": [SEG]}]
    base = {"event_id": "E1", "ticker": "ACME", "fiscal_period": "Q3 FY2024", "call_datetime_utc": "2024-10-31T21:00:00Z", "language": "en", "sections": sections}
    (tmp_path / "a.json").write_text(json.dumps(base, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({**base, "event_id": "E2", "segments": [SEG, SEG]}, indent=2))
    docs = readers.transcripts(spark, str(tmp_path))
    assert {r.event_id: r.n for r in docs.select("event_id", F.size("segments").alias("n")).collect()} == {"E1": 1, "E2": 2}
    assert readers.transcript_segments(docs).count() == 2
    assert ql.document_errors(docs, "event_id", sections=["operator_intro"]).count() == 0
    errors = ql.document_errors(docs, "event_id")
    assert {(r.rule, r.detail) for r in errors.collect()} == {("section", "prepared_remarks"), ("section", "qa")}
    raw = json.dumps({k: v for k, v in base.items() if k != "language"})
    assert spark.range(1).select(ql.absent_fields(F.lit(raw), ql.ROOT)).first()[0] == ["language"]


def test_metrics_in_listed_order(spark, tmp_path):
    doc = {"ticker": "ACME", "fiscal_period": "Q1 FY2026", "audio_duration_sec": 3600.0, "queue_drained": True, "section_counts": {"qa": 3},
           "chunk_metrics": [{"chunk_idx": 0, "proc_time_sec": 1.5, "duration_sec": 60.0}]}
    (tmp_path / "m.json").write_text(json.dumps(doc))
    calls = spark.createDataFrame([("ACME_Q2_FY2026", 0), ("ACME_Q1_FY2026", 1)], "call_key string, ord int")
    rows = readers.call_metrics(spark, str(tmp_path), calls).collect()
    assert [r.missing for r in rows] == [True, False] and rows[1].section_counts == {"qa": 3}


def test_text_sources(spark, tmp_path):
    for sub in ("ref", "out", "log"):
        (tmp_path / sub).mkdir()
    (tmp_path / "ref" / "ACME_Q1.txt").write_text("A\nB")
    (tmp_path / "out" / "whisper_cpp_gpu_ACME_Q1.txt").write_text("[0.5 --> 2.0] hello\nplain")
    (tmp_path / "log" / "f.log").write_text("ACME, http://x, no stream, at all\n\n")
    ref = readers.whole_texts(spark, str(tmp_path / "ref")).first()
    assert (ref.call_id, ref.text) == ("ACME_Q1", "A\nB")
    out = readers.engine_outputs(spark, str(tmp_path / "out")).orderBy("line_no").collect()
    assert [(r.library, r.device, r.clip, r.start, r.end, r.text) for r in out] == [
        ("whisper_cpp", "gpu", "ACME_Q1", 0.5, 2.0, "hello"), ("whisper_cpp", "gpu", "ACME_Q1", None, None, "plain")]
    log = readers.failure_log(spark, str(tmp_path / "log")).collect()
    assert [tuple(r) for r in log] == [("ACME", "http://x", "no stream, at all")]


def test_audio_inventory(spark, tmp_path):
    with wave.open(str(tmp_path / "ACME_Q1.wav"), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(16000), w.writeframes(b"\0\0" * 8000)
    (tmp_path / "odd.wav").write_bytes(b"RIFFxxxx")
    rows = {r.stem: r for r in readers.audio_inventory(spark, str(tmp_path)).collect()}
    r = rows["ACME_Q1"]
    assert (r.canonical, r.sample_rate, r.channels, r.bit_depth, r.duration_sec) == (True, 16000, 1, 16, 0.5)
    assert not rows["odd"].canonical and rows["odd"].duration_sec is None
    audit = ql.audio_standard(readers.audio_inventory(spark, str(tmp_path)), F.lit(20), 2, 15).first()
    assert (audit.total_files, audit.valid_files, audit.status) == (2, 1, "FAIL")


def test_audio_files_with_further_chunks(spark, tmp_path):
    """LIST, fact and odd-sized chunks ahead of the data, and the extensible format, give the same facts as the plain header."""
    chunk = lambda tag, body: tag + len(body).to_bytes(4, "little") + body + b"\0" * (len(body) % 2)
    plain = (1).to_bytes(2, "little") + (2).to_bytes(2, "little") + (8000).to_bytes(4, "little") + (32000).to_bytes(4, "little") + (4).to_bytes(2, "little") + (16).to_bytes(2, "little")
    wide = b"\xfe\xff" + plain[2:] + (22).to_bytes(2, "little") + b"\x10\0\x03\0\0\0" + b"\x03\0" + b"\0" * 14
    data = chunk(b"data", b"\0" * 16000)

    def write(name, *chunks):
        body = b"WAVE" + b"".join(chunks)
        (tmp_path / f"{name}.wav").write_bytes(b"RIFF" + len(body).to_bytes(4, "little") + body)

    write("listed", chunk(b"LIST", b"INFOdata12345"), chunk(b"fmt ", plain), chunk(b"fact", b"\0\0\0\0"), chunk(b"note", b"odd"), data)
    write("wide", chunk(b"fmt ", wide), data)
    write("headless", data)
    write("cut", chunk(b"fmt ", plain))
    rows = {r.stem: (r.canonical, r.sample_rate, r.channels, r.bit_depth, r.encoding, r.duration_sec) for r in readers.audio_inventory(spark, str(tmp_path)).collect()}
    assert rows["listed"] == (False, 8000, 2, 16, 1, 0.5) and rows["wide"] == (False, 8000, 2, 16, 3, 0.5)
    assert rows["headless"] == rows["cut"] == (False, None, None, None, None, None)


def test_documents_and_merge(spark, tmp_path):
    rows = [("E", "ACME", i, float(i), float(i + 1), "S", None, "R", f"t{i}", 0.9, "qa" if i > 1 else "operator_intro") for i in range(4)]
    segs = spark.createDataFrame(rows, "event_id string, ticker string, idx int, start double, end double, speaker_id string, speaker_name string, speaker_role string, text string, confidence double, section string")
    writers.write_documents(writers.transcript_documents(segs, ["event_id", "ticker"]), str(tmp_path / "docs"))
    back = spark.read.schema(schemas.TRANSCRIPT).json(str(tmp_path / "docs" / "ticker=ACME")).first()
    assert [s["type"] for s in back.sections] == ["operator_intro", "prepared_remarks", "qa"] and [g["text"] for g in back.segments] == ["t0", "t1", "t2", "t3"]
    frame = lambda d: spark.createDataFrame(d, "k string, v int")
    writers.merge_into_path(frame([("a", 1), ("b", 1)]), None, str(tmp_path / "v0"), ["k"], F.col("v"))
    writers.merge_into_path(frame([("a", 2)]), str(tmp_path / "v0"), str(tmp_path / "v1"), ["k"], F.col("v"))
    assert {r.k: r.v for r in spark.read.parquet(str(tmp_path / "v1")).collect()} == {"a": 2, "b": 1}


def test_markdown_tables(spark):
    text = "# R\n## 1. Other\n| x |\n| - |\n| no |\n## 2. Mine\nwords\n| A | B |\n| :--- | :--- |\n| 1 | **2** |\n| short |\n| 3 | 4 |\n\n| late | one |\n"
    df = spark.createDataFrame([("r", text), ("s", "nothing")], "name string, text string")
    rows = rp.parse_table(df, "name", "text", "## 2. Mine").orderBy("row_no").collect()
    assert [r.cells for r in rows] == [{"A": "1", "B": "**2**"}, {"A": "3", "B": "4"}]


def test_call_files_are_written_by_all_tasks(spark, monkeypatch):
    """A file a call: the rows reach the writer in more partitions than the planner would fold them into."""
    from pyspark.sql.readwriter import DataFrameWriter

    from callweave.plans import scans

    parts, write = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path, *a, **k: (parts.append(self._df.rdd.getNumPartitions()), write(self, path, *a, **k))[1])
    assert scans.scan_whole_texts(spark, "/root/testdata/sf0.001").count() > 0
    assert parts[0] > int(spark.conf.get("spark.sql.shuffle.partitions"))
