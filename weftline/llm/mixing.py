"""Mixing sources to target weights by iterative proportional fitting; DataFrame functions only.

Documents fall into cells of source, language and topic. The cells' token masses are raked: each margin in turn is
scaled to its target shares, round after round. A cell's rate is its raked mass over its own; a document is sampled
with probability min(1, scale * rate), where the scale is calibrated so that the expected tokens meet the budget
although no probability passes 1. A hash of the id decides, so the same documents are drawn again by any retry.

That scale leaves the margins where many cells are capped (``calibrate``, as the SQL of op1_mixing has it). ``sample``
rakes under the cap instead: no cell is given more than its own mass, and the probabilities have the margins that the
budget allows (``goals``); ``margins`` reports how far these are from the targets.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import cut_lineage, set_aside

#: Stands for a null level.
NONE = "(none)"
WORD = r"[^\x20\x09-\x0D]+"
#: Cells up to this number are sent to all tasks; more are joined by a shuffle.
SMALL = 100_000


def surface_topic(text: Column) -> Column:
    """A coarse topic from a text's form: table, signs, capitals, short or prose; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    signs = F.contains(t, F.lit("&&&")) | F.contains(t, F.lit("***")) | F.contains(t, F.lit("%%%"))
    return F.when(F.contains(t, F.lit(" | ")), "table").when(signs, "signs").when(~t.rlike("[a-z]"), "capitals").when(F.length(t) < 600, "short").otherwise("prose")


def token_mass(text: Column) -> Column:
    """Number of words (runs without ASCII white space)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


@dataclass(frozen=True)
class Plan:
    """Margins: per column either shares by level, or a power by which the margin's own shares are flattened (1: as they
    are, 0: all levels alike). Levels that given shares don't name get ``unnamed``; shares are scaled to add up to 1.
    Raking goes on for ``rounds``, or until no margin is further than ``tolerance`` from its target (relative to it)."""

    margins: Mapping[str, Mapping[str, float] | float]
    kept_share: float = 0.5
    rounds: int = 8
    caps: int = 6
    unnamed: float = 0.01
    seed: int = 17
    tolerance: float = 0.0

    @property
    def columns(self) -> list[str]:
        return list(self.margins)


def _targets(cells: DataFrame, plan: Plan) -> dict[str, DataFrame]:
    out = {}
    for column, rule in plan.margins.items():
        levels = cells.groupBy(column).agg(F.sum("mass").alias("own"))
        if isinstance(rule, Mapping):
            shares = F.create_map(*[F.lit(x) for pair in rule.items() for x in pair])
            raw = F.coalesce(F.element_at(shares, F.col(column)), F.lit(float(plan.unnamed)))
        else:
            raw = F.when(F.col("own") > 0, F.pow(F.col("own"), F.lit(float(rule)))).otherwise(0.0)
        levels = levels.withColumn("raw", raw.cast("double"))
        total = levels.agg(F.sum("raw")).first()[0] or 1.0
        out[column] = cut_lineage(levels.select(column, (F.col("raw") / F.lit(total)).alias("target")))
    return out


def rake(cells: DataFrame, plan: Plan) -> DataFrame:
    """Add ``raked`` to cells (plan.columns, mass): masses whose margins have the targets' shares; their sum stays."""
    targets = _targets(cells, plan)
    total = float(cells.agg(F.sum("mass")).first()[0] or 0.0)
    raked = cells.withColumn("raked", F.col("mass").cast("double"))
    for column, target in targets.items():
        raked = raked.join(target.withColumnRenamed("target", f"target{column}"), column)
    raked = cut_lineage(raked)
    for k in range(1, plan.rounds + 1):
        for column in targets:
            # Sums by level and a join, so that a level with very many cells is no single task.
            now = raked.groupBy(column).agg(F.sum("raked").alias("now"))
            scaled = F.when(F.col("now") > 0, F.col("raked") * (F.col(f"target{column}") * F.lit(total) / F.col("now"))).otherwise(0.0)
            raked = raked.join(now, column).withColumn("raked", scaled).drop("now")
        raked = cut_lineage(raked)
        if plan.tolerance and k < plan.rounds and gap(raked, targets, total) <= plan.tolerance:
            break
    return raked.select(*plan.columns, "mass", "raked")


def gap(raked: DataFrame, targets: Mapping[str, DataFrame], total: float) -> float:
    """The largest relative distance of a margin of ``raked`` from its target."""
    worst = 0.0
    for column in targets:
        level = raked.groupBy(column).agg(F.sum("raked").alias("now"), F.first(f"target{column}").alias("target")).where("target > 0")
        found = level.agg(F.max(F.abs(F.col("now") / (F.col("target") * F.lit(total or 1.0)) - 1))).first()[0]
        worst = max(worst, found or 0.0)
    return worst


def calibrate(raked: DataFrame, plan: Plan) -> DataFrame:
    """Add ``rate`` and ``probability``: those of the cells that the scale would lift over 1 are capped, and the scale is
    set anew from the others, ``plan.caps`` times (each time the capped set can only grow)."""
    rated = raked.withColumn("rate", F.when(F.col("mass") > 0, F.col("raked") / F.col("mass")).otherwise(0.0))
    total = float(rated.agg(F.sum("mass")).first()[0] or 0.0)
    budget, scale = plan.kept_share * total, plan.kept_share
    for _ in range(plan.caps):
        full = F.col("rate") * F.lit(scale) >= 1
        capped, free = rated.agg(F.sum(F.when(full, F.col("mass").cast("double")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("raked")))).first()
        if not free:
            break
        scale = max(scale, (budget - capped) / free)
    return rated.withColumn("probability", F.least(F.lit(1.0), F.col("rate") * F.lit(scale)))


def chance(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) from the id; null ids share one."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(NONE))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def weighed(rows: DataFrame, plan: Plan, mass: str = "mass") -> DataFrame:
    """(plan.columns, mass, raked, rate, probability) of each cell of rows that have those columns and a token mass."""
    cells = cut_lineage(rows.groupBy(*plan.columns).agg(F.sum(mass).alias("mass")))
    return cut_lineage(calibrate(rake(cells, plan), plan))


def goals(cells: DataFrame, plan: Plan) -> dict[str, DataFrame]:
    """Per column (level, own, target, goal): the tokens to keep of each level. A level that has fewer than its target is
    kept whole, and the others share what is left of the budget in the proportions of their targets."""
    total = float(cells.agg(F.sum("mass")).first()[0] or 0.0)
    out = {}
    for column, target in _targets(cells, plan).items():
        own = cells.groupBy(column).agg(F.sum("mass").cast("double").alias("own"))
        levels, scale = cut_lineage(own.join(target, column)), plan.kept_share * total
        while True:
            whole = F.col("target") * F.lit(scale) >= F.col("own")
            kept, free = levels.agg(F.sum(F.when(whole, F.col("own")).otherwise(0.0)), F.sum(F.when(whole, 0.0).otherwise(F.col("target")))).first()
            raised = max(scale, (plan.kept_share * total - kept) / free) if free else scale
            if raised <= scale * (1 + 1e-12):
                break
            scale = raised
        out[column] = levels.withColumn("goal", F.least("own", F.col("target") * F.lit(scale)))
    return out


def rake_within(cells: DataFrame, plan: Plan, goal: Mapping[str, DataFrame]) -> DataFrame:
    """Add ``weight`` and ``kept`` to cells (plan.columns, mass): kept is the lesser of mass and weight, and its margins are
    the goals. In each step a level's weights are scaled by the one factor at which its cells, full ones held at their
    mass, add up to the level's goal."""
    raked = cells.withColumn("weight", F.col("mass").cast("double"))
    for column, levels in goal.items():
        raked = raked.join(levels.select(column, F.col("goal").alias(f"goal{column}")), column)
    raked = cut_lineage(raked)
    for k in range(1, plan.rounds + 1):
        for column in goal:
            level = Window.partitionBy(column)
            by_room = level.orderBy("room")
            at = F.struct(F.col("place"), F.col("factor"))
            raked = (
                raked.withColumn("room", F.when(F.col("weight") > 0, F.col("mass") / F.col("weight")).otherwise(float("inf")))
                .withColumn("place", F.row_number().over(by_room))
                .withColumn("full", F.coalesce(F.sum("mass").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                .withColumn("rest", F.sum("weight").over(by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
                .withColumn("factor", F.when(F.col("rest") > 0, (F.col(f"goal{column}") - F.col("full")) / F.col("rest")))
                .withColumn("found", F.min(F.when(F.col("factor") <= F.col("room"), at)).over(level)["factor"])
                .withColumn("most", F.max(F.when(F.col("weight") > 0, F.col("room"))).over(level))
                .withColumn("weight", F.col("weight") * F.coalesce("found", "most", F.lit(0.0)))
                .drop("room", "place", "full", "rest", "factor", "found", "most")
            )
        if k % 2 == 0 or k == plan.rounds:
            raked = cut_lineage(raked)
    return raked.select(*plan.columns, "mass", "weight", F.least(F.col("mass").cast("double"), "weight").alias("kept"))


def weighed_within(rows: DataFrame, plan: Plan, mass: str = "mass") -> DataFrame:
    """(plan.columns, mass, weight, kept, rate, probability) of each cell: mass * probability has the goals as margins."""
    cells = cut_lineage(rows.groupBy(*plan.columns).agg(F.sum(mass).alias("mass")))
    raked = rake_within(cells, plan, goals(cells, plan))
    part = lambda c: F.when(F.col("mass") > 0, F.col(c) / F.col("mass")).otherwise(0.0)
    return cut_lineage(raked.withColumn("rate", part("weight")).withColumn("probability", part("kept")))


def margins(cells: DataFrame, plan: Plan) -> DataFrame:
    """(margin, level, own, target, goal, kept) as shares: where target and goal differ, the level is too small for its
    target or takes what such levels leave; kept is what the probabilities of ``cells`` are expected to keep."""
    total = float(cells.agg(F.sum("mass")).first()[0] or 0.0) or 1.0
    got = float(cells.agg(F.sum(F.col("mass") * F.col("probability"))).first()[0] or 0.0) or 1.0
    out = None
    for column, levels in goals(cells, plan).items():
        kept = cells.groupBy(column).agg((F.sum(F.col("mass") * F.col("probability")) / F.lit(got)).alias("kept"))
        shares = levels.select(column, (F.col("own") / F.lit(total)).alias("own"), "target", (F.col("goal") / F.lit(plan.kept_share * total)).alias("goal"))
        one = shares.join(kept, column).select(F.lit(column).alias("margin"), F.col(column).alias("level"), "own", "target", "goal", "kept")
        out = one if out is None else out.unionByName(one)
    return out


def attach(rows: DataFrame, cells: DataFrame, plan: Plan, *names: str) -> DataFrame:
    """Add the cells' columns ``names`` (if none are given, rate and probability) to each row. Cells go to all tasks only where they are counted few;
    else a shuffle joins them, in which Spark splits a crowded cell's rows."""
    rated = cells.select(*plan.columns, *(names or ("rate", "probability")))
    return rows.join(F.broadcast(rated) if cells.count() <= SMALL else rated, plan.columns)


def described(docs: DataFrame, text: str = "text", source: str = "source", language: str = "lang", topic: str | None = None, tokens: str | None = None) -> DataFrame:
    """Add __source, __language, __topic and __mass to documents; null levels become "(none)".

    ``topic``, ``tokens``: columns that have them (a classifier's topics, a tokenizer's counts; null counts weigh nothing);
    without them a text's form stands for its topic and its number of words for its tokens.
    """
    return docs.select(
        "*",
        F.coalesce(F.col(source).cast("string"), F.lit(NONE)).alias("__source"),
        F.coalesce(F.col(language).cast("string"), F.lit(NONE)).alias("__language"),
        (F.coalesce(F.col(topic).cast("string"), F.lit(NONE)) if topic else surface_topic(F.col(text))).alias("__topic"),
        (F.coalesce(F.col(tokens).cast("long"), F.lit(0)) if tokens else token_mass(F.col(text))).alias("__mass"),
    )


def default_plan(kept_share: float = 0.5) -> Plan:
    """Sources by the square root of their size, languages flatter, topics nearly alike."""
    return Plan({"__source": 0.5, "__language": 0.3, "__topic": 0.2}, kept_share)


def sample(docs: DataFrame, plan: Plan, id_col: str = "doc_id", **names: str) -> DataFrame:
    """The documents drawn; all columns stay, whatever their names. Texts without words weigh nothing: they are drawn as
    their cell is.

    An empty table gives no rows; repeated rows are drawn or left together.
    """
    read = {"text": "text", "source": "source", "language": "lang"} | names
    carried, restored = set_aside(docs, [n for n in read.values() if n] + [id_col])
    rows = described(carried, **names)
    cells = weighed_within(rows, plan, "__mass")
    # Rates go by names of their own, as a column that is read may be called so.
    rated = attach(rows, cells.withColumnsRenamed({"rate": "__rate", "probability": "__probability"}), plan, "__rate", "__probability")
    return restored(rated.where(chance(F.col(id_col), plan.seed) < F.col("__probability")))


def oracle_sql(plan: Plan) -> str:
    """The same in DuckDB SQL, the rounds written out one after the other; margins given as powers only."""
    names = {"__source": "source", "__language": "lang", "__topic": "topic"}
    columns = ", ".join(names[c] for c in plan.columns)
    steps = [
        f"""described AS (
            SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
                CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table'
                    WHEN contains(coalesce(text, ''), '&&&') OR contains(coalesce(text, ''), '***') OR contains(coalesce(text, ''), '%%%') THEN 'signs'
                    WHEN NOT regexp_matches(coalesce(text, ''), '[a-z]') THEN 'capitals' WHEN length(coalesce(text, '')) < 600 THEN 'short' ELSE 'prose' END AS topic,
                CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS mass FROM documents)""",
        f"cells AS (SELECT {columns}, CAST(sum(mass) AS BIGINT) AS mass FROM described GROUP BY ALL)",
        "total AS (SELECT CAST(sum(mass) AS DOUBLE) AS t FROM cells)",
        "raked0 AS (SELECT *, CAST(mass AS DOUBLE) AS raked FROM cells)",
    ]
    for c, power in plan.margins.items():
        n = names[c]
        steps.append(f"target_{n} AS (SELECT {n}, r / sum(r) OVER () AS target FROM (SELECT {n}, CASE WHEN sum(mass) > 0 THEN pow(sum(mass), {float(power)}) ELSE 0 END AS r FROM cells GROUP BY {n}))")
    k = 0
    for _ in range(plan.rounds):
        for c in plan.columns:
            n = names[c]
            steps.append(f"raked{k + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (raked), CASE WHEN sum(raked) OVER (PARTITION BY r.{n}) > 0 THEN raked * (target * t / sum(raked) OVER (PARTITION BY r.{n})) ELSE 0 END AS raked FROM raked{k} r JOIN target_{n} g ON r.{n} = g.{n}, total)")
            k += 1
    steps += [f"rated AS MATERIALIZED (SELECT *, CASE WHEN mass > 0 THEN raked / mass ELSE 0 END AS rate FROM raked{k})", f"scale0 AS (SELECT CAST({plan.kept_share} AS DOUBLE) AS s)"]
    for i in range(plan.caps):
        full = "rate * s >= 1"
        steps.append(f"scale{i + 1} AS MATERIALIZED (SELECT greatest(any_value(s), coalesce(({plan.kept_share} * any_value(t) - sum(CASE WHEN {full} THEN mass ELSE 0 END)) / nullif(sum(CASE WHEN {full} THEN 0 ELSE raked END), 0), any_value(s))) AS s FROM rated, scale{i}, total)")
    chance_sql = f"CAST(('0x' || substr(md5('{plan.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '{NONE}')), 1, 8)) AS BIGINT) / 4294967296.0"
    return "WITH " + ",\n".join(steps) + f"""
        SELECT doc_id, d.source, d.lang, d.topic, d.mass AS n_tokens, round(rate, 9) AS rate, round(least(1.0, rate * s), 9) AS probability, {chance_sql} < least(1.0, rate * s) AS sampled
        FROM described d JOIN rated r ON d.source = r.source AND d.lang = r.lang AND d.topic = r.topic, scale{plan.caps}"""
