"""Columns with names that an operator would like to use itself, and archives written over."""

from headroom.llm import decontam, mixing, setjoin, warc
from headroom.session import fresh_path
from tests.llm.test_operators import prose

NAMES = ["own", "key", "once", "copy", "_own", "_key", "_once", "_copy", "bad_doc", "bad_key", "_bad_doc", "_bad_key", "topic", "weight", "scale",
         "_mix_topic", "_mix_source", "_mix_lang", "_mix_weight", "_mix_scale", "result", "n_hit", "root", "doc", "component"]


def clashing(spark):
    texts = [prose(i, 40) for i in range(12)]
    texts += [texts[0], texts[1]]
    rows = [(i, t, ("en", "de")[i % 2], "web", *[f"{n}-{i}" for n in NAMES]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in NAMES))
    return docs, {r[0]: tuple(r) for r in rows}


def test_stages_keep_every_column_as_it_was(spark):
    docs, rows = clashing(spark)
    benchmark = spark.createDataFrame([("b", rows[3][1])], "item_id string, text string")
    for name, got, ids in (
            ("keep_one", setjoin.keep_one(docs), set(range(12))),
            ("decontaminate", decontam.decontaminate(docs, benchmark), set(rows) - {3})):
        found = [tuple(r) for r in got.collect()]
        assert got.columns == docs.columns, name
        assert {r[0] for r in found} == ids and len(found) == len(ids), name
        assert all(rows[r[0]] == r for r in found), name
    out, own = mixing.mix(docs)
    assert out.columns == [*docs.columns, own]
    assert sorted(tuple(r)[:-1] for r in out.collect()) == sorted(rows.values())


def test_archive_appends_or_replaces(spark):
    warc.register(spark)
    path = fresh_path(spark, "warc")
    rows = spark.createDataFrame([("<urn:page:1>", "response", "u", "1970-01-01T00:00:00Z", None, "sha1:x", 3, b"abc")],
                                 warc.SCHEMA + ", payload binary")
    for mode, n in (("append", 1), ("append", 2), ("overwrite", 1), ("append", 2), ("overwrite", 1)):
        rows.write.format("warc").mode(mode).save(path)
        assert spark.read.format("warc").load(path).count() == n, mode


def test_aborted_archive_leaves_no_files(tmp_path):
    import os

    import pyarrow as pa
    writer = warc.WarcWriter(str(tmp_path))
    row = {"record_id": "r", "record_type": "response", "target_uri": "u", "date": "d", "refers_to": None, "payload_digest": "p", "payload_bytes": 1, "payload": b"a"}
    message = writer.write(iter([pa.RecordBatch.from_pylist([row])]))
    assert [f for f in os.listdir(tmp_path) if f.endswith(".warc.gz")]
    writer.abort([message, None])
    assert not [f for f in os.listdir(tmp_path) if f.endswith(".warc.gz")]
