"""Summary work: prompts, costs, queue, results and the cost ledger."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import holds, ladder, present
from ..functions.text import token_count
from ..operators.aggregates import count_where
from ..operators.calendar import days_back
from ..operators.incremental import budget_gate, cache_misses, lookback

# Task names, the model each task uses, prices in dollars per
# million input and output tokens, and the daily budget.
TASK_MODELS: dict[str, str] = {
    "executive_summary": "haiku",
    "key_insights": "haiku",
    "tech_analysis": "haiku",
    "competitive_analysis": "sonnet",
    "risk_assessment": "sonnet",
    "business_intelligence": "sonnet",
}
PRICES: dict[str, tuple[float, float]] = {"haiku": (0.25, 1.25), "sonnet": (3.0, 15.0)}
TOKENS_PER_WORD, OUTPUT_SHARE = 1.3, 0.3
DAILY_BUDGET = 50.0
ALERTS = [(1.0, "1.0"), (0.9, "0.9"), (0.8, "0.8")]

#: Default prompt templates; callers may pass their own.
TEMPLATES: dict[str, str] = {
    task: (
        f"Task: {task.replace('_', ' ')}. Answer as one JSON object.\n"
        "Name: {company_name}\nIndustry: {industry}\nDescription: {description}\nWebsite: {web_content}\n"
    )
    for task in TASK_MODELS
}


def price_of(model: Column, side: int) -> Column:
    """Dollars per token of a model; unknown models are priced as haiku."""
    (first, first_price), *rest = PRICES.items()
    out = F.lit(first_price[side])
    for name, price in rest:
        out = F.when(model.contains(name), F.lit(price[side])).otherwise(out)
    return out / F.lit(1_000_000.0)


def call_cost(model: Column, input_tokens: Column, output_tokens: Column) -> Column:
    return input_tokens * price_of(model, 0) + output_tokens * price_of(model, 1)


def model_for(task: Column) -> Column:
    out = F.lit("sonnet")
    for name, model in TASK_MODELS.items():
        out = F.when(task == name, F.lit(model)).otherwise(out)
    return out


def estimate_cost(df: DataFrame, prompt: str = "prompt", model: str = "model") -> DataFrame:
    """Token estimate of a prompt and its cost before the call."""
    tokens = token_count(prompt) * F.lit(TOKENS_PER_WORD)
    return df.withColumn("estimated_tokens", tokens).withColumn(
        "estimated_cost",
        call_cost(F.col(model), F.col("estimated_tokens"), F.col("estimated_tokens") * F.lit(OUTPUT_SHARE)),
    )


def build_prompts(
    companies: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    description_chars: int | None = None,
    web_chars: int | None = None,
) -> DataFrame:
    """One prompt per company and task; the task list is expanded in the row.

    Texts enter whole unless the caller gives a length.
    """

    def text(column: str, chars: int | None) -> Column:
        whole = F.coalesce(column, F.lit(""))
        return whole if chars is None else F.substring(whole, 1, chars)

    rows = F.array(*[F.struct(F.lit(t).alias("task_type"), F.lit(p).alias("template")) for t, p in templates.items()])
    tasks = companies.withColumn("_t", F.explode(rows)).select(*companies.columns, "_t.task_type", "_t.template")
    industry = F.when(present("industry"), F.col("industry")).otherwise(F.lit("Unknown"))
    values = {
        "company_name": F.coalesce("company_name", F.lit("")),
        "industry": industry,
        "description": text("description", description_chars),
        "web_content": text("web_content", web_chars),
    }
    prompt = F.col("template")
    for name, value in values.items():
        prompt = F.replace(prompt, F.lit("{" + name + "}"), value)
    return tasks.withColumns({"prompt": prompt, "model": model_for(F.col("task_type"))}).drop("template")


def embedding_input(profile: str = "profile_text") -> Column:
    """Profile text with industry and country appended."""
    return F.concat(
        F.coalesce(profile, F.lit("")),
        F.lit(" | Industry: "),
        F.coalesce("industry", F.lit("")),
        F.lit(" | Country: "),
        F.coalesce("country", F.lit("")),
    )


def parse_answer(answer: Column) -> Column:
    """Answer text as JSON; plain text is kept under ``raw_response``."""
    valid = holds(F.get_json_object(answer, "$").isNotNull())
    return F.when(valid, answer).otherwise(F.to_json(F.struct(answer.alias("raw_response"))))


def parse_insights(answer: Column) -> Column:
    """Answer as a string array; anything else becomes its single element."""
    listed = F.when(F.trim(answer).startswith("["), F.from_json(answer, "array<string>"))
    return F.coalesce(listed, F.array(answer))


def summary_queue(
    profiles: DataFrame,
    cache: DataFrame,
    as_of: str,
    budget: float = DAILY_BUDGET,
    max_items: int | None = None,
    days: int = 7,
) -> DataFrame:
    """Work of the day: recent profiles × tasks, not cached, within budget.

    The cache is asked on narrow keys first, so prompts are built for its misses
    only.  The newest profiles go first; the gate sees keys and costs, not texts.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    recent = lookback(profiles, "updated_at", as_of, f"'{days}' DAY", inclusive=False).where(present("profile_text"))
    tasks = F.explode(F.array(*[F.lit(t) for t in TEMPLATES])).alias("task_type")
    keys = ["company_key", "task_type", "content_hash"]
    missed = cache_misses(recent.select("company_key", "content_hash", tasks), cache, keys, "expires_at", now)
    wanted = missed.groupBy("company_key", "content_hash").agg(F.collect_set("task_type").alias("_wanted"))  # six at most
    wanted = wanted.withColumnsRenamed({"company_key": "_key", "content_hash": "_hash"})
    same = F.col("company_key").eqNullSafe(F.col("_key")) & F.col("content_hash").eqNullSafe(F.col("_hash"))
    open_rows = recent.join(wanted, same).drop("_key", "_hash")
    work = estimate_cost(build_prompts(open_rows).where(F.array_contains("_wanted", F.col("task_type"))))
    narrow = work.select("company_key", "task_type", "model", "content_hash", "updated_at", "estimated_cost")
    order = [F.col("updated_at").desc(), F.col("company_key").asc(), F.col("task_type").asc()]
    gated = budget_gate(narrow, ["company_key", "task_type"], order, F.col("estimated_cost"), budget, max_items)
    return gated.where(F.col("admitted")).drop("admitted")


def summary_pivot(results: DataFrame, tasks: Sequence[str] = tuple(TASK_MODELS)) -> DataFrame:
    """One row per company: newest answer of each task, and the summed cost."""
    latest = [
        F.max_by(F.when(F.col("task_type") == t, F.col("result")), F.when(F.col("task_type") == t, F.col("seq"))).alias(t)
        for t in tasks
    ]
    return results.groupBy("company_key").agg(
        *latest, F.sum(F.coalesce("cost_usd", F.lit(0.0))).alias("processing_cost_usd")
    )


def cost_per_day(calls: DataFrame, budget: float = DAILY_BUDGET) -> DataFrame:
    """Daily ledger: totals, means, splits by model and task, rates, budget."""
    model, task = F.col("model"), F.col("task_type")
    cost = F.col("cost_usd")
    n = F.count(F.lit(1))
    daily = calls.groupBy("dt").agg(
        n.alias("total_requests"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum(cost).alias("total_cost_usd"),
        F.avg(cost).alias("avg_cost_per_request"),
        *[count_where(model == m).alias(f"claude_{m}_requests") for m in PRICES],
        *[F.sum(F.when(model == m, cost).otherwise(F.lit(0.0))).alias(f"claude_{m}_cost") for m in PRICES],
        *[count_where(task == t).alias(f"{t}_requests") for t in TASK_MODELS],
        F.avg(F.col("was_cached").cast("double")).alias("cache_hit_rate"),
        F.avg((~F.col("success")).cast("double")).alias("error_rate"),
        F.avg("processing_time_ms").alias("avg_processing_time_ms"),
    )
    return daily.withColumns(
        {
            "avg_cost_per_token": F.try_divide(F.col("total_cost_usd"), F.col("total_tokens").cast("double")),
            "daily_budget_usd": F.lit(budget),
            "budget_utilization": F.col("total_cost_usd") / F.lit(budget),
            "remaining_budget_usd": F.lit(budget) - F.col("total_cost_usd"),
        }
    )


def alert_level(utilization: Column) -> Column:
    """Highest budget threshold that is reached, null below the first."""
    label = ladder(utilization, ALERTS, "")
    return F.when(label != "", label)


def cost_summary(daily: DataFrame, as_of: str, days: int = 7, budget: float = DAILY_BUDGET) -> DataFrame:
    """Spend of the last ``days`` days; a day without rows counts as 0.

    Missing days add nothing to the sum, so the mean divides by ``days``.
    """
    end = F.lit(as_of).cast("date")
    window = daily.where(F.col("dt").between(F.date_sub(end, days - 1).cast("string"), F.lit(as_of)))
    total = F.coalesce(F.sum("total_cost_usd"), F.lit(0.0))
    use = total / F.lit(budget * days)
    return window.agg(
        F.lit(days).alias("period_days"),
        total.alias("total_cost"),
        (total / F.lit(float(days))).alias("average_daily_cost"),
        F.count(F.lit(1)).alias("days_with_cost"),
        (use * 100.0).alias("budget_utilization"),
        alert_level(use).alias("alert_level"),
    )


def cost_by_day(daily: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Every one of the last ``days`` days with its cost, 0 where none."""
    calendar = days_back(daily.sparkSession, as_of, days - 1)
    costs = daily.select("dt", F.col("total_cost_usd").alias("cost"))
    return calendar.join(costs, "dt", "left").withColumn("cost", F.coalesce("cost", F.lit(0.0)))


def cache_stats(cache: DataFrame, now: Column) -> DataFrame:
    """Entries in all, created in the last day, and expired."""
    day_ago = now - F.expr("INTERVAL 1 DAY")
    return cache.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(F.col("created_at") > day_ago).alias("recent_items"),
        F.count_if(F.col("expires_at") < now).alias("expired_items"),
    )


ANALYSIS_SCHEMA = (
    "struct<technology: struct<primary_technologies: array<string>, tech_maturity_score: double>, "
    "risk: struct<overall_risk_level: string, risk_score: double, red_flags: array<string>>>"
)


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """Fields of a struct column as ``struct_field`` columns, one level deep."""
    fields = df.schema[column].dataType
    flat = []
    for outer in fields.fields:
        inner = getattr(outer.dataType, "fields", None)
        if inner is None:
            flat.append(F.col(f"{column}.{outer.name}").alias(outer.name))
        else:
            flat += [F.col(f"{column}.{outer.name}.{f.name}").alias(f"{outer.name}_{f.name}") for f in inner]
    return df.select(*[c for c in df.columns if c != column], *flat)


def nest_columns(df: DataFrame, groups: Mapping[str, Sequence[str]], out: str) -> DataFrame:
    """Reverse of ``flatten_struct``: prefixed columns back into one struct."""
    parts = [
        F.struct(*[F.col(f"{g}_{f}").alias(f) for f in fields]).alias(g) for g, fields in groups.items()
    ]
    used = {f"{g}_{f}" for g, fields in groups.items() for f in fields}
    return df.select(*[c for c in df.columns if c not in used], F.struct(*parts).alias(out))
