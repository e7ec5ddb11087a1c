"""What each of five document filters removes in every order, by contractions of a contingency tensor.

=========  ============================================================================================
flags      column expressions: which of the filters a text fails by itself (A to D)
labels     one left join by id; a document has a label if any of its label rows says so
copies     rows fall together by the digest of their text, combined before they are shuffled. A group
           keeps one row per part and label, however many copies it has; its smallest id passes E
tensor     counts per part, label and outcome of the five filters: 32 cells, 2x2x2x2x2
steps      ``einsum`` over the tensor, with pass, fail or all selected along each axis: every order's
           every step at once
=========  ============================================================================================

Nothing grows with the documents once they are counted, so the 600 steps cost the same for any table.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
#: Fewest words (A), distinct words in a hundred (B), most capitals in a hundred code points (C).
FEWEST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 100, 80, 10
#: Characters that a text may not hold (D).
SIGNS = "[#$%&*|]"

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"
_CAPITALS = "".join(map(chr, range(ord("A"), ord("Z") + 1)))

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

STEP_COLUMNS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def own_flags(text: Column) -> dict[str, Column]:
    """Whether a text fails the filters that look at it alone. No words are no repeated words."""
    words = F.regexp_count(text, F.lit(_WORD))
    distinct = F.size(F.array_distinct(F.array_remove(F.split(text, _SPACE), "")))
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": words < FEWEST_WORDS,
        "B": distinct * 100 < words * DISTINCT_PERCENT,
        "C": capitals * 100 > F.length(text) * CAPITALS_PERCENT,
        "D": text.rlike(SIGNS),
    }


def outcomes(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Documents counted by part, filters failed and labels: ``part, code, good, toxic, n``.

    Bit ``k`` of ``code`` tells that filter ``k`` fails. A null text is the empty one and a null part
    the empty text; a document without a label is neither good nor toxic. Documents without an id are
    no copies of others and others are none of theirs. Rows of one id and text count each, and none
    is a copy of the other; an id with several texts counts each. Columns called otherwise are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    code = sum(fails.cast("int") * (1 << k) for k, fails in enumerate(own_flags(F.col("text")).values()))
    rows = docs.select(F.col(id).alias("id"), whole.alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    rows = rows.select("id", "part", code.alias("code"), F.sha2("text", 256).alias("digest"))
    told = labels.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id"))
    told = told.agg(*[F.coalesce(F.max(F.col(name) == 1), F.lit(False)).alias(alias) for name, alias in (("quality", "good"), ("toxic", "toxic"))])
    labelled = rows.join(told, "id", "left").withColumns({name: F.coalesce(name, F.lit(False)) for name in ("good", "toxic")})

    # Rows of one id meet first, where the join has already put them, so that the smallest id of a
    # group comes with its number of rows and all further steps combine before they shuffle.
    kind = ["digest", "part", "code", "good", "toxic"]
    ids = labelled.groupBy("id", *kind).agg(F.count("*").alias("n"))
    groups = ids.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.min("id").alias("least"),
        F.min_by("n", "id").alias("n_least"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("n_without"),
    )
    first = F.min("least").over(Window.partitionBy("digest"))
    open_rows = F.col("n_without") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    split = groups.withColumn("first", first).withColumn("open", open_rows)
    copies = 1 << FILTERS.index("E")
    sides = F.array(
        F.struct(F.col("code").alias("code"), F.col("open").alias("n")),
        F.struct((F.col("code") + copies).alias("code"), (F.col("n") - F.col("open")).alias("n")),
    )
    cells = split.select("part", "good", "toxic", F.explode(sides).alias("cell")).where(F.col("cell.n") > 0)
    return cells.groupBy("part", F.col("cell.code").alias("code"), "good", "toxic").agg(F.sum("cell.n").alias("n"))


def _selectors(chosen: list[dict[int, tuple[int, int]]]) -> list[np.ndarray]:
    """One array per axis: what each step takes along it, everything unless said otherwise."""
    return [np.array([step.get(axis, ALL) for step in chosen], dtype=np.int64) for axis in range(len(FILTERS))]


def contract(tensor: np.ndarray, chosen: list[dict[int, tuple[int, int]]]) -> np.ndarray:
    """The documents that each of ``chosen`` selects, for every leading index of ``tensor``."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensor, *_selectors(chosen), optimize=True)


ORDERS = ["".join(order) for order in permutations(FILTERS)]
#: Every step as (axes passed before it, its own axis).
STEPS = [([FILTERS.index(f) for f in order[:k]], FILTERS.index(order[k])) for order in ORDERS for k in range(len(FILTERS))]


def audit(tensor: np.ndarray) -> pd.DataFrame:
    """All steps of all orders from counts of shape (3, 2, 2, 2, 2, 2): all documents, good ones, toxic ones."""
    others = range(len(FILTERS))
    kept = contract(tensor, [dict.fromkeys([*before, own], PASS) for before, own in STEPS])
    removed = contract(tensor, [dict.fromkeys(before, PASS) | {own: FAIL} for before, own in STEPS])
    failing = contract(tensor, [{own: FAIL} for _, own in STEPS])
    alone = contract(tensor, [dict.fromkeys(others, PASS) | {own: FAIL} for _, own in STEPS])
    own = np.array([axis for _, axis in STEPS])
    over_orders = np.zeros(len(FILTERS), dtype=np.int64)
    np.add.at(over_orders, own, removed[0])
    return pd.DataFrame(
        {
            "filter_order": np.repeat(ORDERS, len(FILTERS)),
            "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)),
            "kept": kept[0],
            "removed": removed[0],
            "redundant": failing[0] - removed[0],
            "unique_fails": alone[0],
            "good_lost": removed[1],
            "toxic_lost": removed[2],
            "shapley": over_orders[own],
        }
    )


def _audit_part(rows: pd.DataFrame) -> pd.DataFrame:
    """The steps of one part, from its at most 128 cells."""
    tensor = np.zeros((3, 1 << len(FILTERS)), dtype=np.int64)
    for kind, counted in enumerate((rows, rows[rows["good"]], rows[rows["toxic"]])):
        np.add.at(tensor[kind], counted["code"].to_numpy(), counted["n"].to_numpy())
    # Bit k of a code is axis k, so the first axis has the highest stride last: reversed on reshaping.
    shaped = tensor.reshape(3, *[2] * len(FILTERS)).transpose(0, *range(len(FILTERS), 0, -1))
    steps = audit(shaped)
    steps.insert(0, "part", rows["part"].iloc[0])
    return steps


def interactions(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Every step of every order of the five filters, per part: the columns of ``STEP_COLUMNS``.

    The cases of ``outcomes`` hold; an empty table has no parts, so no rows, and a part whose
    documents fail nothing has all its rows with zeros.
    """
    counted = outcomes(docs, labels, id=id, text=text, part=part)
    return counted.groupBy("part").applyInPandas(_audit_part, STEP_COLUMNS)
