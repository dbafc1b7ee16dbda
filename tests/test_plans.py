"""Plan-shape checks for the scale properties the design relies on."""

import contextlib
import io
import re

import pytest

from __spark_entry__ import queries
from headroom.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(text: str) -> str:
    return text.split("\n\n")[0]


@pytest.mark.parametrize("name", ["clean_compute", "clean_storage", "clean_network"])
def test_dedupe_combines_map_side_before_its_exchange(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "partial_min_by" in text
    # The only wide exchange on raw rows is the de-duplication one (network may add its lookup join).
    exchanges = re.findall(r"^\(\d+\) Exchange", text, re.M)
    join_exchanges = 2 if "SortMergeJoin" in text else 0  # the lookup join, when it is not broadcast
    assert len(exchanges) == 1 + join_exchanges


def test_scans_prune_columns_and_push_filters(spark):
    text = plan(queries()["clean_storage"](spark, SF))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "l_returnflag" not in read and "l_linestatus" not in read
    net = plan(queries()["clean_network"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_custkey)]" in net
    assert re.search(r"ReadSchema: struct<c_custkey:bigint,c_acctbal:double>", net)


def test_recommendations_scan_each_raw_table_once(spark):
    text = plan(queries()["recommendations"](spark, SF))
    scans = re.findall(r"^\(\d+\) Scan parquet", text, re.M)
    assert len(scans) == 4  # lineitem, events, orders, customer


def test_no_python_udf_in_any_registered_query(spark):
    for name, q in QUERIES.items():  # queries of the optional subpackage may use Python
        if name.startswith(("stream_", "incremental_", "roundtrip_")) or name == "end_to_end_roundtrip":
            continue  # these run their own jobs; covered by their own tests
        text = plan(q(spark, SF))
        assert not re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsIn|MapIn)", text), name


def test_no_unchecked_broadcast_hints():
    import pathlib
    src = pathlib.Path(__file__).resolve().parents[1] / "headroom"
    hint = re.compile(r"""\b(F|functions)\.broadcast\(|import .*\bbroadcast\b|hint\(\s*["']broadcast""")
    for p in src.rglob("*.py"):
        assert not hint.search(p.read_text()), p
