"""Request-log operators: routing, keys, cost, fallback, access, usage.

All are stateless column expressions, small joins or aggregates, and run on a
batch table or on a stream alike. Rules and limits are configuration: they are
given as Python values and become CASE expressions, so no join and no pairing
of requests with rules takes place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.operators.graph import numbered

# Where a request names nothing (fixed values).
DEFAULT_PROVIDER = "opencode"
DEFAULT_MODEL = "gpt-4o"

# Price per 1000 tokens, prompt and completion, by exact model name (fixed values).
RATES = {
    "gpt-4o": (0.0025, 0.01),
    "gpt-4o-mini": (0.00015, 0.0006),
    "claude-sonnet-4": (0.003, 0.015),
    "claude-haiku-4": (0.00025, 0.00125),
    "deepseek-chat": (0.00027, 0.0011),
}
OTHER_RATE = (0.001, 0.002)
DEFAULT_RPM = 60  # fixed value


def first_user_text(messages: DataFrame, key: str, turn: str, role: str = "role", text: str = "text") -> DataFrame:
    """First user message per conversation, from one row per message."""
    user = F.when(F.col(role) == "user", F.struct(turn, text))
    return messages.groupBy(key).agg(F.coalesce(F.min(user)[text], F.lit("")).alias("prompt"))


def user_text(messages: Column | str) -> Column:
    """First user message of a messages array."""
    users = F.filter(messages, lambda m: m["role"] == "user")
    return F.coalesce(F.get(F.transform(users, lambda m: m["content"]), 0), F.lit(""))


def lookup(column: Column, values: Mapping[str, object], default: Column) -> Column:
    """CASE over a configuration mapping."""
    result = None
    for name, value in values.items():
        hit, value = column == name, F.lit(value)
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return default if result is None else result.otherwise(default)


def route(
    requests: DataFrame,
    providers: Mapping[str, str | None],
    rules: Sequence[tuple[str, str, str]],
    prompt: str = "prompt",
    model: str = "model",
    model_name: str | None = None,
) -> DataFrame:
    """Add ``provider`` and ``routed_model``.

    First a model that names a provider, then the first (pattern, provider,
    model) rule found in the prompt, whatever its case, then the first provider.
    """
    wanted, text = F.col(model), F.col(prompt)
    named = wanted.isin(*providers) if providers else F.lit(False)
    own = lookup(wanted, {p: m for p, m in providers.items() if m}, wanted)
    if model_name:
        own = F.coalesce(F.nullif(model_name, F.lit("")), own)
    first = next(iter(providers), DEFAULT_PROVIDER)
    provider, target = F.when(named, wanted), F.when(named, own)
    for pattern, rule_provider, rule_model in rules:
        hit = text.rlike("(?iu)" + pattern)
        provider, target = provider.when(hit, rule_provider), target.when(hit, rule_model)
    return requests.withColumns(
        {
            "provider": provider.otherwise(first),
            "routed_model": target.otherwise(F.coalesce(F.nullif(wanted, F.lit("")), F.lit(DEFAULT_MODEL))),
        }
    )


def _message_parts(place: Column, role: Column, text: Column) -> list[Column]:
    """Four whole numbers from the hash of a message at its place. Lengths stand before the texts, so
    no two messages are written alike, and null is not empty."""
    sizes = [F.coalesce(F.length(c), F.lit(-1)).cast("string") for c in (role, text)]
    written = F.concat_ws("|", place.cast("string"), *sizes, F.coalesce(role, F.lit("")), F.coalesce(text, F.lit("")))
    digest = F.sha2(written, 256)
    return [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]


def _whole_key(model: Column, count: Column, sums: list[Column]) -> Column:
    model_size = F.coalesce(F.length(model), F.lit(-1)).cast("string")
    return F.sha2(F.concat_ws("|", model_size, F.coalesce(model, F.lit("")), count.cast("string"), *[s.cast("string") for s in sums]), 256)


def request_key(model: Column | str, messages: Column | str) -> Column:
    """Key of a request whose messages are an array of (role, content).

    Same key for the same model and messages in the same order; other settings do not
    count. Hashes of the messages at their places are added up, so :func:`message_key`
    gives the same key from rows.
    """
    model = F.col(model) if isinstance(model, str) else model
    messages = F.coalesce(F.col(messages) if isinstance(messages, str) else messages, F.array())
    parts = F.transform(messages, lambda m, i: F.array(*_message_parts(i, m["role"], m["content"])))

    def added(k: int) -> Column:
        return F.aggregate(parts, F.lit(0).cast("decimal(38,0)"), lambda a, p: (a + p[k]).cast("decimal(38,0)"))

    sums = [added(k) for k in range(4)]
    return _whole_key(model, F.size(messages), sums)


def message_key(messages: DataFrame, key: str, model: str, turn: str, role: str = "role", text: str = "text") -> DataFrame:
    """The same key from one row per message, without bringing a request's messages together.

    The order of the turns counts, not their numbers (null first; equal ones by role and
    text). Places are numbered in stretches, and map tasks add up their part of the
    hashes, so even a very long conversation is one row per task.
    """
    group = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit(""))
    place = F.coalesce(F.col(turn).cast("bigint"), F.lit(-(1 << 62)))
    rows = messages.select(
        F.col(key).alias("_key"), F.col(model).alias("_model"), F.col(role).alias("_role"), F.col(text).alias("_text"),
        group.alias("_group"), place.alias("_place"),
    )
    placed = numbered(rows, "_group", "_place", then=("_role", "_text"))
    sums = [F.sum(p).cast("decimal(38,0)") for p in _message_parts(F.col("n") - 1, F.col("_role"), F.col("_text"))]
    return placed.groupBy(F.col("_key").alias(key), F.col("_model").alias(model)).agg(
        _whole_key(F.max("_model"), F.count("*"), sums).alias("request_key")
    )


def cost(model: Column | str, prompt_tokens: Column | str, completion_tokens: Column | str) -> Column:
    model = F.col(model) if isinstance(model, str) else model
    per_prompt = lookup(model, {m: r[0] for m, r in RATES.items()}, F.lit(OTHER_RATE[0]))
    per_completion = lookup(model, {m: r[1] for m, r in RATES.items()}, F.lit(OTHER_RATE[1]))
    tokens = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)) for c in (prompt_tokens, completion_tokens)]
    return tokens[0] / 1000 * per_prompt + tokens[1] / 1000 * per_completion


def exact(cost_: Column) -> Column:
    """Cost as fixed point, for sums that do not depend on the order of rows."""
    return F.round(cost_, 9).cast("decimal(28,9)")


def rpm_limit(provider: Column | str, overrides: Mapping[str, int], default: int = DEFAULT_RPM) -> Column:
    return lookup(F.col(provider) if isinstance(provider, str) else provider, overrides, F.lit(default))


def resolve_fallback(attempts: DataFrame, request: str, position: str, ok: str, *carried: str) -> DataFrame:
    """Per request the first provider of its chain that answered; failed if none did."""
    won = F.min(F.when(F.col(ok), F.struct(position, *carried))).alias("won")
    return attempts.groupBy(request).agg(won, F.count("*").alias("tries")).select(
        request,
        F.when(F.col("won").isNotNull(), "success").otherwise("failed").alias("status"),
        *[F.col(f"won.{c}").alias(c) for c in (position, *carried)],
        "tries",
    )


def fallback_attempts(requests: DataFrame, chains: Mapping[str, Sequence[str]], provider_models: Mapping[str, str]) -> DataFrame:
    """One row per possible try of each request: its own provider, then the
    configured ones, each with that provider's model or else the request's."""
    chain = lookup(F.col("provider"), {}, F.array().cast("array<string>"))
    for name, others in chains.items():
        chain = F.when(F.col("provider") == name, F.array(*map(F.lit, others))).otherwise(chain)
    tries = F.concat(F.array("provider"), chain)
    out = requests.select("*", F.posexplode(tries).alias("chain_pos", "try_provider"))
    own = lookup(F.col("try_provider"), provider_models, F.col("model"))
    return out.withColumn("try_model", F.when(F.col("chain_pos") == 0, F.col("model")).otherwise(own))


def bearer_key(authorization: Column, x_api_key: Column) -> Column:
    """Key from ``Bearer <key>``, else from the X-API-Key header."""
    bearer = F.when(authorization.startswith("Bearer "), F.trim(F.substring(authorization, 8, 2147483647)))
    return F.coalesce(F.nullif(bearer, F.lit("")), x_api_key, F.lit(""))


def access_check(requests: DataFrame, grants: DataFrame | None, key: str = "api_key", provider: str | None = None) -> DataFrame:
    """Add ``http_status``: 200, 401 without a key, 403 for a key without grants.

    ``grants`` has ``api_key`` and ``providers``; a key may have several rows, whose
    providers add up. None means open access. With
    ``provider`` the provider must be among the granted ones as well.
    """
    if grants is None:
        return requests.withColumn("http_status", F.lit(200))
    given = grants.filter(F.size("providers") > 0).groupBy(F.col("api_key").alias("_granted")).agg(
        F.array_distinct(F.flatten(F.collect_set("providers"))).alias("_providers")
    )
    allowed = F.col("_granted").isNotNull()
    if provider:
        allowed = allowed & F.array_contains("_providers", F.col(provider))
    missing = F.coalesce(F.col(key), F.lit("")) == ""
    return (
        requests.join(given, F.col(key) == F.col("_granted"), "left")
        .withColumn("http_status", F.when(missing, 401).when(allowed, 200).otherwise(403))
        .drop("_granted", "_providers")
    )


def usage(requests: DataFrame, *by: str) -> DataFrame:
    """Calls, tokens and cost per group; needs ``cost`` and the token columns."""
    return requests.groupBy(*by).agg(
        F.count("*").alias("calls"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum(exact(F.col("cost"))).cast("double").alias("cost"),
    )


def per_minute(requests: DataFrame, time: str, *by: str) -> DataFrame:
    """Requests per minute, the unit limits are given in."""
    return requests.groupBy(*by, F.window(time, "1 minute").alias("minute")).agg(F.count("*").alias("requests")).select(
        *by, F.unix_micros("minute.start").alias("minute_us"), "requests"
    )


def model_catalog(rules: DataFrame, providers: DataFrame) -> DataFrame:
    """Distinct provider/model of the rules, in rule order; of the providers where
    there are no rules."""
    listed = rules.groupBy("provider", "model").agg(F.min("rule_no").alias("place"))
    any_rule = rules.limit(1).agg((F.count("*") > 0).alias("has_rules"))
    spare = providers.select("provider", F.coalesce("model", F.lit(DEFAULT_MODEL)).alias("model"), "place")
    spare = spare.groupBy("provider", "model").agg(F.min("place").alias("place"))
    spare = spare.join(F.broadcast(any_rule)).filter("NOT has_rules").drop("has_rules")
    return listed.unionByName(spare).withColumn("id", F.concat_ws("/", "provider", "model"))


def purge(responses: DataFrame, model: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(responses that stay, one row with the number ``removed``); all go without a model."""
    gone = F.lit(True) if model is None else F.coalesce(F.col("model") == model, F.lit(False))
    return responses.filter(~gone), responses.agg(F.count_if(gone).alias("removed"))
