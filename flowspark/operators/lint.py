"""Lint rules over the step table: one finding row (flow, step, rule, detail) per violation.

Rules that look at one step only are judged together in a single pass. Rules
about the graph are joins on (flow, step); where several are asked for, those of small flows
are worked out flow by flow (:mod:`flowspark.operators.flowlint`), and only large
flows go through the joins. Text rules are regular expressions,
so approximations by design.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.operators import flowlint
from flowspark.operators.graph import edges, inherited, placed_levels, stored
from flowspark.session import ship_package

STEP_PREFIXES = "^(LOAD|FILTER|TRANSFORM|JOIN|AGGREGATE|ENRICH|SAVE)_"
# FROM and JOIN targets; after FROM also the further ones of a comma list
SOURCES = (
    r"(?i)\b(?:FROM|JOIN)\s+([A-Za-z_][A-Za-z0-9_.]*(?:\s+(?:AS\s+)?(?!JOIN\b)\w+)?"
    r"(?:\s*,\s*[A-Za-z_][A-Za-z0-9_.]*(?:\s+(?:AS\s+)?(?!JOIN\b)\w+)?)*)"
)
# tried at the start of a word, or where the match before ended, and without going back: no other place can match
NOT_NULL = r"(?i)(?:(?<!\w)|\G)(\w++)\s++IS\s++NOT\s++NULL"
# a plain column, with or without its table's alias, in SUM or AVG
BARE_SUM = r"(?i)\b(?:SUM|AVG)\(\s*(?:\w+\.)?(\w+)\s*\)"
CTE_NAME = r"(?i)(?:\bWITH\s+|,\s*)(\w+)\s+AS\s*\("
EXTRACT_FROM = r"(?i)\bEXTRACT\s*\([^()]*\)"
# brackets with up to four more levels inside
BRACKETS = r"\((?:[^()]|\((?:[^()]|\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\))*\))*\)"
TABLE_VARIABLE = r"\$\{(\w+)\}"
#: Of these a text holds one, in any case, wherever the pattern matches.
NEEDED = {NOT_NULL: ["null"], BARE_SUM: ["sum", "avg"], TABLE_VARIABLE: ["${"]}
SELECT_LIST = r"(?is)^\s*SELECT\s+(.*?)\s+FROM\b"


def _all(pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all("sql_text", F.lit(pattern), F.lit(group))


def _holds(word: str) -> Column:
    """Whether the text has the word in any case: cheaper than the patterns below, which all need it."""
    return F.lower("sql_text").contains(word)


def _several_columns() -> Column:
    listed = F.regexp_replace(F.regexp_extract("sql_text", SELECT_LIST, 1), BRACKETS, "")
    return listed.rlike(r"[^\s,][ \t]*,[ \t]*[^\s]")


def step_rules() -> dict[str, tuple[Column, Column]]:
    """Rule → (violated, detail), decided from one step row."""
    sql, name = F.col("sql_text"), F.col("name")
    save = name.startswith("SAVE_")
    return {
        "trunc_function": (sql.rlike(r"(?i)\bTRUNC\s*\("), F.lit("use DATE_TRUNC or DATE_FORMAT")),
        "left_join_is_null": (sql.rlike(r"(?is)LEFT\s+(OUTER\s+)?JOIN\b.*\bIS\s+NULL\b"), F.lit("use LEFT ANTI JOIN")),
        "select_star": (sql.rlike(r"(?i)SELECT\s+\*") & ~save, F.lit("list the columns")),
        "hint": (sql.rlike(r"/\*\+"), F.regexp_extract(sql, r"/\*\+\s*(\w+)", 1)),
        "step_prefix": (~name.rlike(STEP_PREFIXES), name),
        "view_name_mismatch": (F.col("temp_view") != name, F.col("temp_view")),
        "lowercase_keyword": (
            reduce(Column.__or__, [sql.contains(w) for w in ("select", "from", "where", "join")]) & sql.rlike(r"\b(select|from|where|join)\b"),
            F.lit("write keywords in upper case"),
        ),
        "no_description": (strip_blank("description") == "", F.lit("")),
        "columns_on_one_line": (sql.contains(",") & _several_columns(), F.lit("one column per line")),
    }


def strip_blank(column: str) -> Column:
    return F.trim(F.col(column))


def _finding(df: DataFrame, rule: str, detail: Column | str, step: str = "step") -> DataFrame:
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return df.select("flow", F.col(step).alias("step"), F.lit(rule).alias("rule"), detail.alias("detail"))


def check_steps(steps: DataFrame, rules: Iterable[str] | None = None) -> DataFrame:
    """All one-step rules in one pass over the steps."""
    chosen = {r: v for r, v in step_rules().items() if rules is None or r in set(rules)}
    marks = F.array(
        *[F.when(bad, F.struct(F.lit(rule).alias("rule"), detail.alias("detail"))) for rule, (bad, detail) in chosen.items()]
    )
    # filtered after the generator, as a function over an array's elements would have all patterns interpreted
    found = steps.select("flow", F.col("name").alias("step"), F.explode(marks).alias("f")).filter("f IS NOT NULL")
    return found.select("flow", "step", "f.rule", "f.detail")


def check_flows(steps: DataFrame) -> DataFrame:
    """Flow name style and single-step flows, from one aggregate per flow."""
    flows = steps.groupBy("flow").agg(F.max("flow_name").alias("flow_name"), F.count("*").alias("n"))
    marks = F.array(
        F.when(
            ~F.col("flow_name").rlike("^[A-Z][A-Z0-9_]*$"),
            F.struct(F.lit("flow_name_case").alias("rule"), F.col("flow_name").alias("detail")),
        ),
        F.when(F.col("n") == 1, F.struct(F.lit("single_step").alias("rule"), F.lit("").alias("detail"))),
    )
    return flows.select("flow", F.lit("").alias("step"), F.explode(F.array_compact(marks)).alias("f")).select(
        "flow", "step", "f.rule", "f.detail"
    )


class Shared:
    """What several rules about the graph need, each computed once and stored."""

    def __init__(self, steps: DataFrame, kinds: Iterable[str] = ("view", "filter", "source")):
        self.steps = steps.hint("merge")
        self.kinds = set(kinds)

    @cached_property
    def edges(self) -> DataFrame:
        return stored(edges(self.steps))

    @cached_property
    def links(self) -> DataFrame:
        return self.edges.filter("known").select("flow", "parent", "child")

    @cached_property
    def reads(self) -> DataFrame:
        return stored(view_reads(self.steps))

    @cached_property
    def indirect_reads(self) -> DataFrame:
        direct = self.links.select("flow", F.col("child").alias("step"), F.col("parent").alias("owner"))
        return self.reads.join(direct, ["flow", "step", "owner"], "left_anti")

    @cached_property
    def filtered(self) -> DataFrame:
        return stored(_facts(self.steps, NOT_NULL))

    @cached_property
    def named_sources(self) -> DataFrame:
        return stored(_facts(self.steps, TABLE_VARIABLE, fold_case=False))

    @cached_property
    def carried(self) -> DataFrame:
        """Facts of all kinds, carried downstream together."""
        facts = {
            "view": lambda: self.indirect_reads.select("flow", F.col("owner").alias("name"), F.col("owner").alias("fact")),
            "filter": lambda: self.filtered,
            "source": lambda: self.named_sources,
        }
        parts = [facts[k]().withColumn("fact", F.concat(F.lit(k + ":"), "fact")) for k in sorted(self.kinds)]
        return inherited(self.links, reduce(DataFrame.unionByName, parts))

    def inherited(self, kind: str) -> DataFrame:
        start = len(kind) + 2
        mine = self.carried.hint("merge").filter(F.col("fact").startswith(kind + ":"))
        return mine.select("flow", "name", F.substring("fact", start, 2147483647).alias("fact"))


def duplicate_step(t: Shared) -> DataFrame:
    twice = t.steps.groupBy("flow", "name").agg(F.count("*").alias("n")).filter("n > 1")
    return _finding(twice, "duplicate_step", F.col("n").cast("string"), "name")


def unknown_parent(t: Shared) -> DataFrame:
    return _finding(t.edges.filter(~F.col("known")), "unknown_parent", F.col("parent"), "child")


def cycle(t: Shared) -> DataFrame:
    """What cannot be placed even when parents that are no steps are left out."""
    _, rest = placed_levels(t.steps, ignore_unknown=True)
    return _finding(rest, "cycle", "on or behind a cycle", "name")


def orphan_step(t: Shared) -> DataFrame:
    parents = t.edges.select("flow", F.col("parent").alias("name")).distinct()
    several = t.steps.groupBy("flow").agg(F.count("*").alias("n")).filter("n > 1").select("flow")
    alone = t.steps.filter(F.size("parents") == 0).select("flow", "name")
    alone = alone.join(parents, ["flow", "name"], "left_anti").join(several, "flow", "left_semi")
    return _finding(alone, "orphan_step", "no parents and no children", "name")


def order_not_after_parent(t: Shared) -> DataFrame:
    orders = t.steps.groupBy("flow", "name").agg(F.max_by("ord", "pos").alias("ord"))
    parents = orders.select("flow", F.col("name").alias("parent"), F.col("ord").alias("parent_ord"))
    children = orders.select("flow", F.col("name").alias("child"), F.col("ord").alias("child_ord"))
    late = t.links.join(parents, ["flow", "parent"]).join(children, ["flow", "child"]).filter("child_ord <= parent_ord")
    return _finding(late, "order_not_after_parent", F.col("parent"), "child")


def early_target(t: Shared) -> DataFrame:
    feeds = t.edges.select("flow", F.col("parent").alias("name")).distinct().withColumn("feeds", F.lit(True))
    stored = t.steps.filter("target_table <> ''").select("flow", "name", "target_table")
    early = stored.join(feeds, ["flow", "name"], "left").filter(
        F.coalesce("feeds", F.lit(False)) | ~F.col("name").startswith("SAVE_")
    )
    return _finding(early, "early_target", F.col("target_table"), "name")


def inactive_parent(t: Shared) -> DataFrame:
    state = t.steps.groupBy("flow", "name").agg(F.max_by("active", "pos").alias("active"))
    off = state.filter("NOT active").select("flow", F.col("name").alias("parent"))
    on = state.filter("active").select("flow", F.col("name").alias("child"))
    pairs = t.links.join(off, ["flow", "parent"], "left_semi").join(on, ["flow", "child"], "left_semi")
    return _finding(pairs, "inactive_parent", F.col("parent"), "child")


def views(steps: DataFrame) -> DataFrame:
    """(flow, view in lower case, owner step): the last step that makes the view."""
    return steps.groupBy("flow", F.lower("temp_view").alias("view")).agg(F.max_by("name", "pos").alias("owner"))


def _targets() -> Column:
    text = F.when(_holds("extract"), F.regexp_replace("sql_text", EXTRACT_FROM, "")).otherwise(F.col("sql_text"))
    listed = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(SOURCES), F.lit(1)), lambda s: F.split(s, r"\s*,\s*")))
    own = F.when(_holds("as"), F.transform(_all(CTE_NAME), F.lower)).otherwise(F.array().cast("array<string>"))
    names = F.array_distinct(F.transform(listed, lambda s: F.regexp_extract(s, r"^(\S+)", 1)))
    return F.filter(names, lambda n: ~F.array_contains(own, F.lower(n)))


def sources(steps: DataFrame) -> DataFrame:
    """(flow, step, target): tables and views named in FROM and JOIN clauses, but for the statement's own CTEs."""
    return steps.select("flow", F.col("name").alias("step"), F.explode(_targets()).alias("target"))


def view_reads(steps: DataFrame) -> DataFrame:
    """(flow, step, view, owner): views of the same flow that a step's SQL reads."""
    named = sources(steps).select("flow", "step", F.lower("target").alias("view")).distinct()
    return named.join(views(steps), ["flow", "view"]).filter("owner <> step").select("flow", "step", "view", "owner")


def hardcoded_table(t: Shared) -> DataFrame:
    named = sources(t.steps).withColumn("view", F.lower("target"))
    return _finding(named.join(views(t.steps), ["flow", "view"], "left_anti"), "hardcoded_table", F.col("target"))


def unread_parent(t: Shared) -> DataFrame:
    read = t.reads.select("flow", F.col("step").alias("child"), F.col("owner").alias("parent"))
    return _finding(t.links.join(read, ["flow", "child", "parent"], "left_anti"), "unread_parent", F.col("parent"), "child")


def _found(pattern: str, fold_case: bool = True) -> Column:
    found = _all(pattern)
    found = F.array_distinct(F.transform(found, F.lower) if fold_case else found)
    return F.when(reduce(Column.__or__, map(_holds, NEEDED[pattern])), found).otherwise(F.array().cast("array<string>"))


def _facts(steps: DataFrame, pattern: str, fold_case: bool = True) -> DataFrame:
    return steps.select("flow", "name", F.explode(_found(pattern, fold_case)).alias("fact"))


def view_not_upstream(t: Shared) -> DataFrame:
    reached = t.inherited("view").select("flow", F.col("name").alias("step"), F.col("fact").alias("owner"))
    return _finding(t.indirect_reads.join(reached, ["flow", "step", "owner"], "left_anti"), "view_not_upstream", F.col("view"))


def repeated_null_filter(t: Shared) -> DataFrame:
    again = t.filtered.join(t.inherited("filter"), ["flow", "name", "fact"], "left_semi")
    return _finding(again, "repeated_null_filter", F.col("fact"), "name")


def repeated_source(t: Shared) -> DataFrame:
    again = t.named_sources.join(t.inherited("source"), ["flow", "name", "fact"], "left_semi")
    return _finding(again, "repeated_source", F.col("fact"), "name")


def unsafe_aggregate(t: Shared) -> DataFrame:
    guarded = t.filtered.unionByName(t.inherited("filter"))
    bare = _facts(t.steps, BARE_SUM).join(guarded, ["flow", "name", "fact"], "left_anti")
    return _finding(bare, "unsafe_aggregate", F.col("fact"), "name")


GRAPH_RULES = {
    f.__name__: f
    for f in (
        duplicate_step, unknown_parent, cycle, orphan_step, view_not_upstream, unread_parent, order_not_after_parent,
        hardcoded_table, early_target, repeated_null_filter, inactive_parent, repeated_source, unsafe_aggregate,
    )
}
FLOW_RULES = ("flow_name_case", "single_step")
CARRIED = {"view_not_upstream": "view", "repeated_null_filter": "filter", "unsafe_aggregate": "filter", "repeated_source": "source"}


#: Rows and bytes of text up to which a flow is a small one, whose rows may meet in one task.
SMALL_ROWS, SMALL_BYTES = 1_000, 1_000_000
_PLAIN = ["name", "pos", "ord", "parents", "temp_view", "target_table", "active", "sql_text"]


def small_and_large(steps: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The steps of small flows, and those of flows that are large, have no key or have rows with nulls; None where
    there are none of these."""
    whole = ~F.exists("parents", lambda p: p.isNull())
    for c in _PLAIN:
        whole = whole & F.col(c).isNotNull()
    size = F.octet_length("sql_text") + F.size("parents") + F.aggregate("parents", F.lit(0), lambda n, p: n + F.octet_length(p))
    flows = steps.groupBy("flow").agg(F.count("*").alias("n"), F.sum(size.cast("bigint")).alias("size"), F.bool_and(F.coalesce(whole, F.lit(False))).alias("whole"))
    apart = stored(flows.filter(f"n > {SMALL_ROWS} OR size > {SMALL_BYTES} OR NOT whole OR flow IS NULL").select("flow"))
    if apart.isEmpty():
        return steps, None
    large = steps.join(apart, "flow", "left_semi").unionByName(steps.filter("flow IS NULL"))
    return steps.filter("flow IS NOT NULL").join(apart, "flow", "left_anti"), stored(large)


def check_small_flows(steps: DataFrame, rules: Iterable[str]) -> DataFrame:
    """Findings of rules about the graph, of flows whose rows may meet in one task; see :func:`small_and_large`."""
    ship_package(steps.sparkSession)
    chosen, kind = set(rules), steps.schema["flow"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in flowlint.chunks(batches):
            yield from flowlint.findings(table, chosen)

    facts = steps.select(
        "flow", "name", F.col("pos").cast("bigint").alias("pos"), F.col("ord").cast("bigint").alias("ord"), "active", "target_table", "parents",
        F.lower("temp_view").alias("view"), _targets().alias("targets"), _found(NOT_NULL).alias("filters"),
        _found(TABLE_VARIABLE, fold_case=False).alias("sources"), _found(BARE_SUM).alias("summed"),
    )
    dealt = facts.repartition("flow").sortWithinPartitions("flow").withColumn("target_views", F.transform("targets", F.lower))
    return dealt.mapInArrow(check, f"flow {kind}, step string, rule string, detail string")


def lint(steps: DataFrame, rules: Iterable[str] | None = None) -> DataFrame:
    """Findings of the chosen rules, of all without a choice.

    ``steps`` is read several times, so it should be a stored table.
    """
    chosen = list(rules) if rules is not None else [*step_rules(), *FLOW_RULES, *GRAPH_RULES]
    parts = []
    row = [r for r in chosen if r in step_rules()]
    if row:
        parts.append(check_steps(steps, row))
    flow = [r for r in chosen if r in FLOW_RULES]
    if flow:
        parts.append(check_flows(steps).filter(F.col("rule").isin(flow)))
    graph = [r for r in chosen if r in GRAPH_RULES]
    large: DataFrame | None = steps
    if len(graph) > 1:
        small, large = small_and_large(steps)
        parts.append(check_small_flows(small, graph))
    if large is not None:
        shared = Shared(large, {CARRIED[r] for r in graph if r in CARRIED})
        parts += [GRAPH_RULES[r](shared) for r in graph]
    return reduce(DataFrame.unionByName, parts)


def step_sources(steps: DataFrame) -> DataFrame:
    """(flow, step, source, direct): table variables each step depends on, named in
    its own SQL or reached through its parents."""
    t = Shared(steps, ["source"])
    both = t.named_sources.withColumn("direct", F.lit(True)).unionByName(t.inherited("source").withColumn("direct", F.lit(False)))
    return both.groupBy("flow", F.col("name").alias("step"), F.col("fact").alias("source")).agg(F.bool_or("direct").alias("direct"))


def target_lineage(steps: DataFrame) -> DataFrame:
    """(flow, target, step): every step that feeds a stored table, the writer included."""
    writers = steps.filter("target_table <> ''").select("flow", "name", F.concat_ws(".", "target_table", "name").alias("fact"))
    up = edges(steps).filter("known").select("flow", F.col("child").alias("parent"), F.col("parent").alias("child"))
    up = stored(up)
    return inherited(up, writers).unionByName(writers).distinct().select("flow", F.col("fact").alias("target"), F.col("name").alias("step"))
