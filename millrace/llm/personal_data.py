"""Personal data by weak supervision, in column expressions alone.

=============  =====================================================================================
base spans     e-mail addresses, IP addresses, card numbers and phone numbers by fixed patterns; they
               always stay
candidates     base spans, near misses of them, and further shapes (national phone numbers, spelled-out
               addresses, secrets)
labelers       pattern, gazetteer, context and shape each vote for, against or not at all
reliabilities  expectation maximisation over the counts of equal vote patterns estimates how often each
               labeler is right, without labels
classifier     a logistic model over votes and surroundings, trained on the resulting chances; it scores
               every candidate, also those whose vote pattern is rare
=============  =====================================================================================

Texts are read where they lie; the one shuffle carries counts of vote patterns, of which there are a
few thousand at most by construction. Patterns are written so that the time for a text grows with its
length: no nested repetition, and no second try inside a run of characters that has failed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
LABELERS = ("pattern", "gazetteer", "context", "shape")
#: The chance from which a candidate that is no base span becomes a span.
LEAST = 0.5

# The patterns of base spans, as they are defined.
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)        parts at most 255
#   card   [0-9]([\x20-]?[0-9])+                       16 to 19 digits, Luhn
#   phone  \+[0-9][\x20().0-9-]+[0-9]                  8 to 15 digits
# A joint (a dot between labels, a blank or hyphen between digits) is first written as one character
# that no pattern knows, so that "joined parts" become a plain run; places stay the same.
_JOINT, _NO_JOINT = "\ue000", "\ue001"
_LABEL, _LOCAL = r"A-Za-z0-9\-", r"A-Za-z0-9._%+\-"
_PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}{_JOINT}])|\G)[{_LOCAL}{_JOINT}]++@[{_LABEL}]++{_JOINT}[{_LABEL}{_JOINT}]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9][0-9{_JOINT}]++",
    "phone": r"\+[0-9][ ().0-9\-]+[0-9]",
    # Shapes that the base has not.
    "local": r"(?<![0-9+.)\-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9])",
    "spelled": rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?[(\[](?:at|AT)[)\]] ?[{_LABEL}]++ ?(?:[(\[](?:dot|DOT)[)\]]|\.) ?[A-Za-z]{{2,}}+",
    "secret": r"(?<![A-Za-z0-9_\-])(?=[A-Za-z_\-]*+[0-9])[A-Za-z0-9_\-]{20,}+",
}
#: What a text must contain for a pattern to be tried.
_SIGNS = {
    "email": r"@[A-Za-z0-9\-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][ \-]?[0-9]",
    "phone": r"\+[0-9]",
    "local": r"[0-9]{3}[ .\-][0-9]{4}",
    "spelled": r"[(\[](?:at|AT)[)\]]",
    "secret": r"(?<![A-Za-z0-9_\-])[A-Za-z0-9_\-]{20}",
}
_KIND_OF = {"local": "phone", "spelled": "email"}

# What the labelers look for.
_WORDS = {
    "email": r"(?i)\b(?:e-?mails?|mailto|contact|write|reach)\b\W*(?:\w+\W+){0,2}$",
    "ip": r"(?i)\b(?:ip|host|server|client|address|from)\b\W*(?:\w+\W+){0,2}$",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment)\b\W*(?:\w+\W+){0,2}$",
    "phone": r"(?i)\b(?:tel|telephone|phone|call|mobile|cell|fax|ring)\b\W*(?:\w+\W+){0,2}$",
    "secret": r"(?i)\b(?:token|secret|password|passwd|pwd|api[_ -]?key|access[_ -]?key|auth|bearer|credential)s?\b[\s:=\"'\-]*$",
}
_AGAINST = r"(?i)\b(?:version|isbn|issn|order|invoice|serial|chapter|section|sha|commit|md5|checksum|digest|doi)\b\W*(?:\w+\W+){0,2}$"
_KNOWN = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us|ca|au|jp|in|br|nl|ch|at|be|se|pl)$",
    "ip": r"^(?!0+\.|0*127\.|0*255\.|0*22[4-9]\.|0*23[0-9]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5|4[4-9]))",
    "phone": r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9])",
    "secret": r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|(?:sk|pk|gh[pousr]|xox[bp]|AKIA|AIza)[_\-A-Za-z0-9]+)$",
}

_BLOCK = 256


def _prepared(text: Column) -> dict[str, Column]:
    """What each pattern reads: the text, with joints where the pattern wants them."""
    plain = F.translate(text, _JOINT, _NO_JOINT)
    dotted = F.regexp_replace(plain, rf"(?<=[{_LABEL}])\.(?=[{_LABEL}])", _JOINT)
    spaced = F.regexp_replace(plain, r"(?<=[0-9])[ \-](?=[0-9])", _JOINT)
    return {"email": dotted, "card": spaced}


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _block_total(lengths: Column) -> Callable:
    return lambda b: _total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))


def _total_before(blocks: Column) -> Callable:
    return lambda b: _total(F.slice(blocks, F.lit(1), b))


def _placed(pieces: Column, lengths: Column, sums: Column) -> Callable:
    def place(found: Column, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        before = F.get(pieces, i)
        start = F.get(sums, block) + _total(F.slice(lengths, block * _BLOCK + 1, i - block * _BLOCK)) + F.length(before)
        return F.struct(
            start.alias("start"),
            (start + F.length(found)).alias("end"),
            found.alias("found"),
            F.substring(before, -40, 40).alias("before"),
            F.substring(F.get(pieces, i + 1), 1, 1).alias("next"),
        )

    return place


def _with_matches(df: DataFrame, text: Column, shapes: tuple[str, ...], prefix: str) -> DataFrame:
    """For every shape an array of (start, end, found, before): all matches, with what stands before each.

    Starts are sums of lengths, taken in blocks: the work for n matches is n times the root of n.
    """
    name = lambda shape, part: F.col(f"{prefix}{shape}_{part}")
    ready = _prepared(text)
    none = F.array().cast("array<string>")
    cut = {}
    for shape in shapes:
        source, pattern = ready.get(shape, text), _PATTERNS[shape]
        pair = F.struct(F.split(source, pattern, -1).alias("pieces"), F.regexp_extract_all(source, F.lit(pattern), F.lit(0)).alias("found"))
        cut[f"{prefix}{shape}_cut"] = F.when(text.rlike(_SIGNS[shape]), pair).otherwise(F.struct(none.alias("pieces"), none.alias("found")))
    df = df.withColumns(cut)
    lengths, blocks, sums, out = {}, {}, {}, {}
    for shape in shapes:
        found, pieces = name(shape, "cut")["found"], name(shape, "cut")["pieces"]
        first = F.slice(pieces, 1, F.size(found))
        lengths[f"{prefix}{shape}_lengths"] = F.zip_with(first, found, lambda p, f: F.length(p) + F.length(f))
        numbers = F.sequence(F.lit(0), F.floor(F.size(found) / _BLOCK).cast("int"))
        blocks[f"{prefix}{shape}_blocks"] = F.transform(numbers, _block_total(name(shape, "lengths")))
        sums[f"{prefix}{shape}_sums"] = F.transform(numbers, _total_before(name(shape, "blocks")))
        out[f"{prefix}{shape}"] = F.transform(found, _placed(pieces, name(shape, "lengths"), name(shape, "sums")))
    helpers = [*cut, *lengths, *blocks, *sums]
    return df.withColumns(lengths).withColumns(blocks).withColumns(sums).withColumns(out).drop(*helpers)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        doubled = F.when(i % 2 == 0, d * 2).otherwise(d)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return _total(F.transform(places, worth)) % 10 == 0


def _passes(shape: str, found: Column) -> Column:
    """Whether a match is a base span of its kind."""
    digits = _digits(found)
    if shape == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        return found.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if shape == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if shape == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(shape == "email")


def _votes(shape: str, m: Column, base: Column) -> list[Column]:
    """The votes of all labelers: 1 for, -1 against, 0 none."""
    kind = _KIND_OF.get(shape, shape)
    found, before = m["found"], m["before"]
    digits = F.length(_digits(found))
    if kind == "email":
        found = F.translate(found, _JOINT, ".")
    if shape == "card":
        known = _digits(found).rlike(_KNOWN["card"])
        shape_vote = F.when(digits.between(16, 19), 1).otherwise(-1)
    elif kind == "phone":
        known = found.rlike(_KNOWN["phone"])
        shape_vote = F.when(digits.between(10, 13), 1).otherwise(-1)
    elif shape == "ip":
        known = found.rlike(_KNOWN["ip"])
        shape_vote = F.when(m["next"].rlike(r"[.\-0-9A-Za-z]") & ~m["next"].eqNullSafe("."), -1).otherwise(1)
    elif kind == "email":
        known = found.rlike(_KNOWN["email"])
        shape_vote = F.when(F.length(found) <= 80, 1).otherwise(-1)
    else:
        known = found.rlike(_KNOWN["secret"])
        shape_vote = F.when(digits * 10 >= F.length(found) * 2, 1).otherwise(-1)
    pattern = F.when(base, 1).otherwise(F.lit(0) if shape in ("local", "spelled", "secret") else F.lit(-1))
    context = F.when(before.rlike(_AGAINST), -1).when(before.rlike(_WORDS[kind]), 1).otherwise(0)
    return [pattern, F.when(known, 1).otherwise(-1), context, shape_vote]


def _candidate(shape: str, m: Column) -> Column:
    kind = _KIND_OF.get(shape, shape)
    base = _passes(shape, m["found"]) if shape in BASE else F.lit(False)
    votes = [v.cast("int").alias(name) for name, v in zip(LABELERS, _votes(shape, m, base))]
    apart = (m["before"] == "") | m["before"].rlike(r"[\s\"'(=:]$")
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        m["start"].cast("long").alias("start"),
        m["end"].cast("long").alias("end"),
        base.alias("base"),
        *votes,
        apart.cast("int").alias("apart"),
    )


def _candidate_of(shape: str) -> Callable:
    return lambda m: _candidate(shape, m)


def with_candidates(df: DataFrame, text: str, candidates: str) -> DataFrame:
    """``df`` with an array of all candidates, by kind and start."""
    (prefix,) = fresh(df, "pii_")
    shapes = tuple(_PATTERNS)
    source = F.coalesce(F.col(text), F.lit(""))
    found = _with_matches(df, source, shapes, prefix)
    arrays = []
    for shape in shapes:
        matches = F.col(f"{prefix}{shape}")
        if shape == "card":  # two digits are no near miss of a card number
            matches = F.filter(matches, lambda m: F.length(_digits(m["found"])).between(13, 19))
        arrays.append(F.transform(matches, _candidate_of(shape)))
    return found.withColumn(candidates, F.array_sort(F.concat(*arrays))).drop(*[f"{prefix}{s}" for s in shapes])


@dataclass(frozen=True)
class SpanModel:
    """Weights of the span classifier by feature, and the estimated reliabilities (kind, labeler): (true, false)."""

    weights: dict[tuple, float]
    reliability: dict[tuple[int, str], tuple[float, float]]

    def chance(self, candidate: Column) -> Column:
        """The chance that a candidate is personal data."""
        total = F.lit(self.weights.get(("bias",), 0.0))
        for feature, weight in self.weights.items():
            if feature[0] == "vote":
                _, kind, labeler, vote = feature
                total = total + F.when((candidate["kind"] == kind) & (candidate[labeler] == vote), F.lit(weight)).otherwise(F.lit(0.0))
            elif feature[0] == "kind":
                total = total + F.when(candidate["kind"] == feature[1], F.lit(weight)).otherwise(F.lit(0.0))
            elif feature[0] == "apart":
                total = total + F.when(candidate["apart"] == 1, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _expectation_maximisation(patterns: list[tuple[int, tuple[int, ...], float]], rounds: int = 60) -> tuple[list[float], dict]:
    """Chances of vote patterns (kind, votes, count), and the reliabilities of labelers by kind.

    A labeler starts as right four times in five. It is described by the chances of its votes where
    the candidate is and is not personal data; a prior of a few votes keeps rare kinds near the start.
    """
    start = {True: {1: 0.6, 0: 0.3, -1: 0.1}, False: {1: 0.15, 0: 0.3, -1: 0.55}}
    kinds = sorted({k for k, _, _ in patterns})
    table = {(k, j, y): dict(start[y]) for k in kinds for j in range(len(LABELERS)) for y in (True, False)}
    prior = {k: 0.5 for k in kinds}
    chances = [0.5] * len(patterns)
    for _ in range(rounds):
        for n, (k, votes, _) in enumerate(patterns):
            yes = log(prior[k]) + sum(log(table[k, j, True][v]) for j, v in enumerate(votes))
            no = log(1 - prior[k]) + sum(log(table[k, j, False][v]) for j, v in enumerate(votes))
            chances[n] = 1 / (1 + exp(min(50.0, max(-50.0, no - yes))))
        for k in kinds:
            mine = [(votes, c, p) for (kind, votes, c), p in zip(patterns, chances) if kind == k]
            size, positive = sum(c for _, c, _ in mine), sum(c * p for _, c, p in mine)
            prior[k] = (positive + 5) / (size + 10)
            for j in range(len(LABELERS)):
                for y in (True, False):
                    mass = {v: 20 * start[y][v] for v in (1, 0, -1)}
                    for votes, c, p in mine:
                        mass[votes[j]] += c * (p if y else 1 - p)
                    whole = sum(mass.values())
                    table[k, j, y] = {v: m / whole for v, m in mass.items()}
    reliability = {(k, name): (table[k, j, True][1], table[k, j, False][-1]) for k in kinds for j, name in enumerate(LABELERS)}
    return chances, reliability


def _logistic(rows: list[tuple[list[tuple], float, float]], rounds: int = 400) -> dict[tuple, float]:
    """Weights for (features, chance, count) rows: gradient descent on the weighted cross entropy."""
    weights = {f: 0.0 for features, _, _ in rows for f in features}
    if not rows:
        return weights
    strength = [log(1 + c) for _, _, c in rows]  # frequent patterns count more, but not alone
    whole = sum(strength)
    for n in range(rounds):
        slope = dict.fromkeys(weights, 0.0)
        for (features, chance, _), s in zip(rows, strength):
            guess = 1 / (1 + exp(-max(-50.0, min(50.0, sum(weights[f] for f in features)))))
            for f in features:
                slope[f] += s * (guess - chance) / whole
        for f in weights:
            weights[f] -= 6.0 * (slope[f] + 1e-4 * weights[f])
    return weights


def fit(df: DataFrame, text: str = "text") -> SpanModel:
    """A span model from all texts of ``df``. Without candidates every chance is one half, and nothing to judge."""
    (candidates,) = fresh(df, "candidates")
    columns = ["kind", *LABELERS, "apart"]
    # One small struct is exploded as a whole: taking its fields apart would work the array out once for each.
    seen = F.transform(candidates, lambda c: F.struct(*[c[name].alias(name) for name in columns]))
    one = with_candidates(df.select(text), text, candidates).select(F.explode(seen).alias("c"))
    counts = one.groupBy("c").agg(F.count("*").alias("n")).select("c.*", "n").orderBy(columns).collect()
    patterns: dict[tuple, float] = {}
    for r in counts:
        key = (r["kind"], tuple(r[name] for name in LABELERS))
        patterns[key] = patterns.get(key, 0) + r["n"]
    listed = [(kind, votes, n) for (kind, votes), n in patterns.items()]
    chances, reliability = _expectation_maximisation(listed)
    chance_of = {(kind, votes): p for (kind, votes, _), p in zip(listed, chances)}
    rows = []
    for r in counts:
        votes = tuple(r[name] for name in LABELERS)
        features = [("bias",), ("kind", r["kind"])] + [("vote", r["kind"], name, v) for name, v in zip(LABELERS, votes) if v]
        rows.append((features + ([("apart",)] if r["apart"] else []), chance_of[r["kind"], votes], r["n"]))
    return SpanModel(_logistic(rows), reliability)


def find_spans(df: DataFrame, model: SpanModel, text: str = "text", spans: str = "pii_spans", least: float = LEAST) -> DataFrame:
    """``df`` with an array of (kind, start, end, base, chance), by kind (as listed in ``KINDS``) and start.

    Base spans are always there; candidates of at least the chance ``least`` are added unless they
    overlap a base span or an added span of an earlier kind. Places count code points, ends are
    exclusive. Null texts count as empty and have no spans. Rows stay as they are, also repeated
    ones; a column already called ``spans`` is replaced, all others pass through.
    """
    (candidates,) = fresh(df, "candidates")
    found = with_candidates(df, text, candidates)
    scored = F.transform(
        candidates,
        lambda c: F.struct(c["kind"].alias("number"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"), model.chance(c).alias("chance")),
    )
    found = found.withColumn(candidates, F.filter(scored, lambda c: c["base"] | (c["chance"] >= least)))
    overlaps = lambda c: F.exists(
        candidates, lambda o: (o["start"] < c["end"]) & (c["start"] < o["end"]) & (o["base"] | (o["number"] < c["number"]))
    )
    kept = F.filter(candidates, lambda c: c["base"] | ~overlaps(c))
    named = lambda c: F.element_at(F.array(*[F.lit(k) for k in KINDS]), c["number"] + 1)
    return found.withColumn(
        spans,
        F.transform(kept, lambda c: F.struct(named(c).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"), c["chance"].alias("chance"))),
    ).drop(candidates)


def redact(found: DataFrame, text: str = "text", spans: str = "pii_spans") -> DataFrame:
    """``text`` with every span of ``find_spans`` replaced by its kind in angle brackets, as ``<email>``.

    Overlapping spans go together under the name of the first. Texts without spans, also null ones, stay.
    """
    (parts,) = fresh(found, "parts")
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(done: Column, s: Column) -> Column:
        piece = F.array(F.substring(F.col(text), done["at"] + 1, s["start"] - done["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">")))
        grown = F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["out"], piece).alias("out"))
        inside = F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out"))
        return F.when(s["start"] < done["at"], inside).otherwise(grown)

    whole = F.concat(F.array_join(F.col(f"{parts}.out"), ""), F.substring(F.col(text), F.col(f"{parts}.at") + 1, F.length(text)))
    clean = found.withColumn(parts, F.aggregate(by_start, start, step))
    return clean.withColumn(text, F.when(F.size(spans) > 0, whole).otherwise(F.col(text))).drop(parts)
