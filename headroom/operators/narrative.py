"""Narratives for recommendations.

Text generation services are outside Spark; what a Spark job does is (a) build the prompt
column, (b) join a table of service responses (produced by any batch inference job) back on
the recommendation key and (c) fall back to a deterministic template where no usable text
exists. All of it is column expressions and one left join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headroom.config import NO_ACTION
from headroom.functions.text import fmt_one_decimal, rounded_two_decimals, shortest_text

NARRATIVE_KEY = ("resource_type", "resource_id", "forecast_horizon_weeks")

# --- fixed values: template sentences (printf style; %% is a literal percent sign) ---------
NO_ACTION_SENTENCE = "%s is currently operating within normal thresholds (%s%%). No action is required at this time."
ACTION_SENTENCE = "%s is projected to reach %s%s based on current trends (risk level: %s). Recommended action: %s."
HORIZON_PHRASE = " within %s weeks"
# --- end of fixed values ------------------------------------------------------------------

# Whitespace stripped around service text.
_WS = " \t\n\r\x0b\x0c"

# Prompt sent to a text service; our own wording, one placeholder per recommendation field.
PROMPT_TEMPLATE = (
    "Summarise this capacity recommendation for an infrastructure dashboard in two or three factual "
    "sentences. Use only the numbers given.\n"
    "Resource: %s (%s)\n"
    "Recommendation: %s\n"
    "Risk: %s\n"
    "Current value: %s\n"
    "Forecasted value: %s\n"
    "Horizon (weeks): %s\n"
    "Details: %s\n"
)


def action_text(rec_type) -> Column:
    """Recommendation type with underscores as spaces."""
    c = F.col(rec_type) if isinstance(rec_type, str) else rec_type
    return F.translate(c, "_", " ")


def narrative_template(resource_id="resource_id", rec_type="recommendation_type", risk="risk_level",
                       current="current_value", forecast="forecasted_value",
                       horizon="forecast_horizon_weeks") -> Column:
    """Deterministic sentence; only the no_action sentence carries a % sign."""
    rid, rt, rk, cur, fc, h = (F.col(x) if isinstance(x, str) else x
                               for x in (resource_id, rec_type, risk, current, forecast, horizon))
    horizon_text = F.when(h.isNotNull() & (h != 0), F.format_string(HORIZON_PHRASE, h.cast("string"))) \
        .otherwise(F.lit(""))
    no_action = F.format_string(NO_ACTION_SENTENCE, rid, fmt_one_decimal(cur))
    action = F.format_string(ACTION_SENTENCE, rid, fmt_one_decimal(fc), horizon_text, rk, action_text(rt))
    return F.when(rt == NO_ACTION, no_action).otherwise(action)


def details_json(details="details") -> Column:
    """N9 at a sink: the details map as JSON text."""
    return F.to_json(F.col(details) if isinstance(details, str) else details)


def build_prompt(recs: DataFrame) -> DataFrame:
    """Add a ``prompt`` column (values rounded to 2 decimals, details as JSON)."""
    return recs.withColumn("prompt", F.format_string(
        PROMPT_TEMPLATE, F.col("resource_id"), F.col("resource_type"), F.col("recommendation_type"),
        F.col("risk_level"), shortest_text(rounded_two_decimals("current_value")),
        shortest_text(rounded_two_decimals("forecasted_value")), F.col("forecast_horizon_weeks").cast("string"),
        details_json()))


def parse_response(response, provider: str) -> Column:
    """Service text from a raw JSON response, stripped; unusable input -> NULL.

    ``gemini``: ``candidates[0].content.parts[0].text``; ``ollama``: key ``response``
    (absent -> empty). Any other provider yields NULL (template).
    """
    r = F.col(response) if isinstance(response, str) else response
    if provider == "gemini":
        text = F.get_json_object(r, "$.candidates[0].content.parts[0].text")
    elif provider == "ollama":
        valid = F.get_json_object(r, "$").isNotNull()
        text = F.when(valid, F.coalesce(F.get_json_object(r, "$.response"), F.lit("")))
    else:
        return F.lit(None).cast("string")
    return F.btrim(text, F.lit(_WS))


def narrate(recs: DataFrame, responses: DataFrame | None = None, provider: str = "template_fallback") -> DataFrame:
    """``ai_narrative`` = service text when present and non-empty, else the template.

    ``responses`` has the recommendation key (resource_type, resource_id,
    forecast_horizon_weeks) and a raw ``response`` string. Of several responses for one key
    the smallest text that yields a narrative counts, so no recommendation is repeated.
    """
    template = narrative_template()
    if responses is None or provider not in ("gemini", "ollama"):
        return recs.withColumn("ai_narrative", template)
    text = F.nullif(parse_response(F.col("response"), provider), F.lit(""))
    r = responses.groupBy(*NARRATIVE_KEY).agg(F.min(text).alias("_text"))
    joined = recs.join(r, on=list(NARRATIVE_KEY), how="left")
    return joined.withColumn("ai_narrative", F.coalesce("_text", template)).drop("_text")


def narratives_table(recs: DataFrame) -> DataFrame:
    """(resource_type, resource_id, forecast_horizon_weeks, narrative)."""
    col = F.col("ai_narrative") if "ai_narrative" in recs.columns else narrative_template()
    return recs.select(*NARRATIVE_KEY, col.alias("narrative"))
