"""What is landed on the way: compressed lines, no payload beyond its page, no type text of whole objects."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from snaprecon.operators import normalize as nz
from snaprecon.operators import state as ss
from snaprecon.plans import catalog
from snaprecon.sinks import files as sk


def _tables(spark, root) -> str:
    day = dt.datetime(1995, 3, 4)
    orders = [(k, k % 3, "FOP"[k % 3], 1000.5 + k, day, "1-URGENT") for k in range(0, 3300, 7)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{root}/orders.parquet")
    customers = [(0, "Ana \"A\"", 1, 0.0, "AUTO"), (1, None, 1, 0.0, None), (2, "Zé\t\n", 2, 0.0, "HOME")]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{root}/customer.parquet")
    return str(root)


def test_landed_lines_are_compressed_and_read_back_whole(spark, tmp_path):
    rows = spark.createDataFrame([("a", "w", '{"key":"é"}'), ("b", "w", "{}")], "base_origem string, periodo string, json string")
    path = str(tmp_path / "raw")
    sk.write_raw(rows, path)
    assert {f.suffix for f in Path(path).rglob("part-*")} == {".gz"}
    assert {(r.base_origem, r.value) for r in sk.read_raw(spark, path).collect()} == {("a", '{"key":"é"}'), ("b", "{}")}


def test_split_makes_no_type_text_of_fields(spark):
    texts = ['{"fields":{"value":1}}', '{"fields":{}}', "{}", '{"fields":null}', '{"fields":"x"}', '{"fields":[{}]}', "no", '{"fields":5}']
    parsed = nz.parse_raw(spark.createDataFrame([(t,) for t in texts], "value string"))
    good, bad = nz.split_malformed(parsed)
    assert {r.value for r in good.collect()} == set(texts[:3])
    assert {r.value for r in bad.collect()} == set(texts[3:])
    assert "schema_of_variant" not in good._jdf.queryExecution().optimizedPlan().toString().lower()


def test_page_chains_keep_no_payload_once_parsed(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    parsed, _ = catalog._landed_chains(spark, sf)
    assert set(parsed.columns) == {"chain", "asked", "landed", "next_token", "n_issues", "first_issue"}
    placed = {(r.chain, r.position): (r.n_issues, r.first_issue) for r in catalog.page_chain_order(spark, sf).collect()}
    assert placed[0, 0] == (15, "TCK-0") and placed[0, 1] == (14, "TCK-105")


def test_issue_texts_hold_names_of_any_character(spark, tmp_path):
    from snaprecon.plans import fixtures as fx

    rows = fx.issue_json(spark, _tables(spark, tmp_path)).where("o_orderkey in (7, 14, 21)").select("o_orderkey", F.get_json_object("json", "$.fields.summary").alias("s")).collect()
    assert {r.o_orderkey: r.s for r in rows} == {7: None, 14: "Zé\t\n", 21: "Ana \"A\""}


def test_a_batch_is_set_aside_in_columns(spark, tmp_path):
    root = str(tmp_path / "state")
    batch = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "key string, at int, text string")
    ss.merge_batch(batch, root, ["key"], ["at"], 0, buckets=2)
    assert spark.read.parquet(f"{root}/incoming/version=1").count() == 2
    assert [r.text for r in ss.read_state(spark, root, batch.schema).collect()] == ["new"]
