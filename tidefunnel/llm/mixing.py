"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Documents fall into cells (source, language, topic).  Rounds of raking scale the
cells' token weights until the marginal sums of each of the three agree with their
targets; no cell may weigh more than it has.  A document then stays with the
probability weight / tokens of its cell, drawn from a hash of its id, so a second
run keeps the same ones.

DataFrame operations only.  Cells are counted with partial sums before the shuffle,
so a hot source costs one row a task; all later work is on the table of cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefunnel.llm.common import free_name
from tidefunnel.operators.tables import staged

DIMENSIONS = ("source", "lang", "topic")
BUDGET = 0.7  # share of all tokens to keep
POWER = 0.7  # default targets: shares to this power, so that large groups lose some weight
ROUNDS = 12
CELLS = 1_000_000  # up to here the cells of one value are summed in one task

# A document's topic is the first whose pattern is in its text.
TOPICS = (
    ("legal", r"[Ll]icensed under|[Rr]eleased under|[Cc]opyright"),
    ("contact", r"[A-Za-z0-9]@[A-Za-z0-9]|\+[0-9]|\[(EMAIL|IP|CARD|PHONE)\]"),
    ("listing", r" \| [^|\n]* \| "),
)
OTHER = "prose"
WORD = r"[^\x20\x09-\x0D]+"


def topic(text: Column) -> Column:
    found = F.lit(OTHER)
    for name, pattern in reversed(TOPICS):
        found = F.when(text.rlike(pattern), F.lit(name)).otherwise(found)
    return found


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of the id's digits; a NULL id has that of ""."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def _labelled(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        topic(text).alias("topic"),
        F.greatest(F.regexp_count(text, F.lit(WORD)), F.lit(1)).cast("long").alias("n_tokens"),
    )


def default_targets(cells: DataFrame, dimension: str, power: float = POWER) -> DataFrame:
    """(dimension, share): the tokens of each value to ``power``, summing to one."""
    sums = cells.groupBy(dimension).agg(F.pow(F.sum("n_tokens").cast("double"), F.lit(power)).alias("p"))
    total = sums.agg(F.sum("p").alias("total"))  # one row
    return sums.join(F.broadcast(total)).select(dimension, (F.col("p") / F.col("total")).alias("share"))


def rake(
    cells: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    budget: float = BUDGET,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``cells`` (source, lang, topic, n_tokens) with their raked ``weight``.

    ``targets`` maps a dimension to a table (value, share); dimensions that it lacks
    get ``default_targets``.  Values without a target weigh nothing.  Shares are
    those of the budget, ``budget`` times all tokens.  What is done is written to the
    shared folder, so plans do not grow with the rounds.  Up to CELLS cells a round is
    one pass of windows; beyond that each step is an aggregate and a join, which split
    the cells of a frequent value.
    """
    given = targets or {}
    total = cells.agg((F.sum("n_tokens") * F.lit(budget)).alias("wanted"))
    wanted = {
        d: staged(
            given.get(d, default_targets(cells, d))
            .select(d, "share")
            .join(F.broadcast(total))  # one row
            .select(d, (F.col("share") * F.col("wanted")).alias("goal")),
            f"targets-{d}",
        )
        for d in DIMENSIONS
    }
    state = cells.withColumn("weight", F.col("n_tokens") * F.lit(float(budget)))
    for d in DIMENSIONS:
        state = state.join(wanted[d].withColumnRenamed("goal", f"goal_{d}"), d, "left")
    state = staged(state, "goals")
    few = state.count() <= CELLS
    for _ in range(rounds):
        for d in DIMENSIONS:
            state = _scaled(state, d, few)
            if not few:  # a step reads its cells twice, and steps in one plan would double it with each
                state = staged(state, "raked")
        state = staged(state, "raked") if few else state
    return state.drop(*(f"goal_{d}" for d in DIMENSIONS))


def _scaled(state: DataFrame, d: str, few: bool) -> DataFrame:
    """``state`` with the weights scaled to the goals of one dimension, no cell over its tokens."""
    if few:
        state = state.withColumn("have", F.sum("weight").over(Window.partitionBy(d)))
    else:
        state = state.join(state.groupBy(d).agg(F.sum("weight").alias("have")), d)
    factor = F.try_divide(F.coalesce(F.col(f"goal_{d}"), F.lit(0.0)), F.col("have"))
    weight = F.least(F.coalesce(F.col("weight") * factor, F.lit(0.0)), F.col("n_tokens").cast("double"))
    return state.withColumn("weight", weight).drop("have")


def reached(cells: DataFrame, raked: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """dimension, value, n_tokens, goal, weight: what each target asks for and what ``raked`` gives it.

    A goal over ``n_tokens``, or one that only cells without tokens to spare could
    fill, is missed.  ``targets`` and ``budget`` are those that ``raked`` was made with.
    """
    given, found = targets or {}, []
    total = cells.agg((F.sum("n_tokens") * F.lit(budget)).alias("wanted"))
    for d in DIMENSIONS:
        goals = given.get(d, default_targets(cells, d)).select(d, "share").join(F.broadcast(total))  # one row
        sums = raked.groupBy(d).agg(F.sum("n_tokens").alias("n_tokens"), F.sum("weight").alias("weight"))
        found.append(
            sums.join(goals, d, "full").select(
                F.lit(d).alias("dimension"), F.col(d).alias("value"),
                F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
                F.coalesce(F.col("share") * F.col("wanted"), F.lit(0.0)).alias("goal"),
                F.coalesce("weight", F.lit(0.0)).alias("weight"),
            )
        )
    return found[0].union(found[1]).union(found[2])


def mixed(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    budget: float = BUDGET,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability, kept for each row.

    Tokens are words; a NULL or empty text counts as one, NULL sources and languages
    as "".  Rows that share an id share their draw.
    """
    # narrow rows without the texts, read by the cells and by the sampling
    labelled = staged(_labelled(docs, id_col, text_col), "labelled")
    cells = staged(labelled.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")), "cells")
    raked = rake(cells, targets, budget, rounds)
    rates = raked.select(*DIMENSIONS, (F.col("weight") / F.col("n_tokens")).alias("probability"))
    return labelled.join(rates, list(DIMENSIONS)).select(
        "doc_id", *DIMENSIONS, "n_tokens", "probability",
        (uniform(F.col("doc_id")) < F.col("probability")).alias("kept"),
    )


def sampled(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the calibrated probabilities keep, with all their columns.

    Texts are not shuffled while the table of cells is small enough for Spark to
    broadcast it; beyond that it is a plain join that splits hot cells.
    """
    text = F.coalesce(F.col(options.get("text_col", "text")).cast("string"), F.lit(""))
    cells = _labelled(docs, options.get("id_col", "doc_id"), options.get("text_col", "text"))
    cells = staged(cells.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")), "cells")
    raked = rake(cells, **{k: v for k, v in options.items() if k in ("targets", "budget", "rounds")})
    values = {
        "source": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        "topic": topic(text),
    }
    name = {d: free_name(f"cell_{d}", docs.columns) for d in (*DIMENSIONS, "probability")}
    rates = raked.select(
        *(F.col(d).alias(name[d]) for d in DIMENSIONS),
        (F.col("weight") / F.col("n_tokens")).alias(name["probability"]),
    )
    marked = docs.withColumns({name[d]: values[d] for d in DIMENSIONS})
    draw = uniform(F.col(options.get("id_col", "doc_id")).cast("long"))
    stays = marked.join(rates, [name[d] for d in DIMENSIONS]).where(draw < F.col(name["probability"]))
    return stays.select(*docs.columns)


# --- the same for DuckDB -------------------------------------------------------


def mixing_sql(budget: float = BUDGET, rounds: int = ROUNDS, power: float = POWER) -> str:
    cases = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{name}'" for name, p in TOPICS)
    steps = []
    last = "r0"
    for k in range(rounds * len(DIMENSIONS)):
        d = DIMENSIONS[k % len(DIMENSIONS)]
        steps.append(
            f"r{k + 1} AS MATERIALIZED (SELECT source, lang, topic, n, least(n::DOUBLE,"
            f" w * (SELECT share FROM goal WHERE dim = '{d}' AND value = {d}) * (SELECT sum(n) * {budget} FROM cell)"
            f" / sum(w) OVER (PARTITION BY {d})) AS w FROM {last})"
        )
        last = f"r{k + 1}"
    goals = " UNION ALL ".join(
        f"SELECT '{d}' AS dim, {d} AS value, pow(sum(n)::DOUBLE, {power}) / sum(pow(sum(n)::DOUBLE, {power})) OVER () AS share"
        f" FROM cell GROUP BY {d}"
        for d in DIMENSIONS
    )
    return f"""
    WITH d AS (
        SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t,
               CASE {cases} ELSE '{OTHER}' END AS topic,
               greatest(len(regexp_extract_all(t, '{WORD}')), 1)::BIGINT AS n
        FROM documents
    ),
    cell AS MATERIALIZED (SELECT source, lang, topic, sum(n)::BIGINT AS n FROM d GROUP BY ALL),
    goal AS MATERIALIZED ({goals}),
    r0 AS (SELECT *, n * {budget}::DOUBLE AS w FROM cell),
    {", ".join(steps)}
    SELECT doc_id, d.source, d.lang, d.topic, d.n AS n_tokens, w / r.n AS probability,
           ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[:13])::BIGINT / {float(1 << 52)} < w / r.n AS kept
    FROM d JOIN {last} AS r ON d.source = r.source AND d.lang = r.lang AND d.topic = r.topic
    """
