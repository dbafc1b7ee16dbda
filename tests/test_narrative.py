from pyspark.sql import functions as F

from headroom.operators.narrative import build_prompt, narrate, narrative_template, narratives_table

REC_SCHEMA = ("resource_id string, resource_type string, recommendation_type string, risk_level string, "
              "current_value double, forecasted_value double, forecast_horizon_weeks int, details map<string,double>")


def _recs(spark):
    return spark.createDataFrame([
        ("storage-01", "storage", "increase_storage_capacity", "critical", 82.0, 95.0, 10, {"threshold": 90.0}),
        ("cluster-05", "compute", "no_action", "info", 55.0, 55.0, 0, {}),
        ("cluster-02", "compute", "downsize_underutilized_compute", "warning", 19.1022, 19.1022, 0,
         {"days_below_threshold": 30.0}),
    ], REC_SCHEMA)


def _by_id(df, col="ai_narrative"):
    return {r.resource_id: r[col] for r in df.collect()}


def test_template_text(spark):
    t = _by_id(narrate(_recs(spark)))
    assert t["storage-01"] == ("storage-01 is projected to reach 95.0 within 10 weeks based on current trends "
                               "(risk level: critical). Recommended action: increase storage capacity.")
    assert t["cluster-05"] == ("cluster-05 is currently operating within normal thresholds (55.0%). "
                               "No action is required at this time.")
    assert t["cluster-02"] == ("cluster-02 is projected to reach 19.1 based on current trends (risk level: warning). "
                               "Recommended action: downsize underutilized compute.")


def test_one_decimal_rounding_and_large_values(spark):
    df = spark.createDataFrame([("x", 0.25), ("y", 107.5835), ("z", 12345678.94)], "resource_id string, v double")
    out = _by_id(df.select("resource_id", narrative_template(
        F.col("resource_id"), F.lit("no_action"), F.lit("info"), F.col("v"), F.col("v"), F.lit(0)).alias("n")), "n")
    assert "(0.2%)" in out["x"] and "(107.6%)" in out["y"] and "(12345678.9%)" in out["z"]


def _responses(spark, rows):
    return spark.createDataFrame(rows, "resource_type string, resource_id string, forecast_horizon_weeks int, "
                                       "response string")


def test_gemini_responses(spark):
    resp = _responses(spark, [
        ("storage", "storage-01", 10, '{"candidates":[{"content":{"parts":[{"text":"  Grow storage-01.\\n"}]}}]}'),
        ("compute", "cluster-05", 0, "not json at all"),
        ("compute", "cluster-02", 0, '{"candidates":[{"content":{"parts":[{"text":"   "}]}}]}'),
    ])
    t = _by_id(narrate(_recs(spark), resp, provider="gemini"))
    assert t["storage-01"] == "Grow storage-01."
    assert t["cluster-05"].startswith("cluster-05 is currently operating")
    assert t["cluster-02"].startswith("cluster-02 is projected")


def test_ollama_responses_and_unknown_provider(spark):
    resp = _responses(spark, [("storage", "storage-01", 10, '{"response": " Text from a local model. "}'),
                              ("compute", "cluster-05", 0, '{"done": true}')])
    t = _by_id(narrate(_recs(spark), resp, provider="ollama"))
    assert t["storage-01"] == "Text from a local model."
    assert t["cluster-05"].startswith("cluster-05 is currently")  # missing key -> "" -> template
    t = _by_id(narrate(_recs(spark), resp, provider="template_fallback"))
    assert t["storage-01"].startswith("storage-01 is projected")


def test_prompt_and_table(spark):
    p = _by_id(build_prompt(_recs(spark)), "prompt")
    assert "storage-01 (storage)" in p["storage-01"] and "Current value: 82.0" in p["storage-01"]
    assert '{"threshold":90.0}' in p["storage-01"] and "Forecasted value: 19.1" in p["cluster-02"]
    n = narratives_table(narrate(_recs(spark)))
    assert n.columns == ["resource_type", "resource_id", "forecast_horizon_weeks", "narrative"] and n.count() == 3
