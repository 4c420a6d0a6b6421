"""Personal data: high-recall generators, boosted trees over the candidates, calibrated thresholds.

1. *Generators* propose spans, overlapping between kinds: the four base kinds (email, ip, card,
   phone) and three looser ones (contact: written-out addresses, number: long digit groups,
   secret: key-value pairs and long letter-digit runs).
2. Each candidate gets a handful of coarse format and context features.  Candidates of all
   documents are counted by feature cell and rule outcome; the number of cells is bounded by
   the feature table (``CELLS``), whatever the corpus.
3. ``boost`` fits gradient-boosted depth-two trees to the cell counts of one half of the spans,
   ``calibrate`` chooses per kind the lowest score at which the other half is precise enough.
4. The trees become one Spark expression.  Base spans that pass their rule always stay, other
   candidates are added when their score reaches their kind's threshold.

Spans are found by surrounding matches with a private separator, splitting, and adding up lengths,
so positions are code points.  All of it is column expressions.  The patterns are
linear: possessive, and started only where a run of their characters starts.
"""

from __future__ import annotations

import math
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SEP, STAND_IN = "", ""
BASE = ("email", "ip", "card", "phone")
EXTRA = ("contact", "number", "secret")
KINDS = BASE + EXTRA
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "contact": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z0-9-]++)++",
    "number": r"(?<![0-9A-Za-z])[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+",
    "secret": r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\x20?[=:]\x20?[\x22']?[A-Za-z0-9+/_.-]{6,}+[\x22']?"
              r"|(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+",
}
#: A text without this has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "contact": "at"}
CONTEXT = 16
#: Values of each feature; their product bounds the number of cells.
FEATURES = {"kind": len(KINDS), "digits": 6, "separators": 4, "size": 5, "keyword": 2, "edge": 2, "mixed": 2, "form": 3}
CELLS = math.prod(FEATURES.values()) * 4
KEYWORD = r"(?i)(?:phone|tel|call|mobile|card|visa|pay|ip|host|server|mail|contact|pass|token|key|secret)[^A-Za-z0-9]{0,4}$"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _bucket(n: Column, bounds: tuple) -> Column:
    out = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        out = F.when(n < bounds[i], F.lit(i)).otherwise(out)
    return out


def luhn(digits: Column) -> Column:
    d = F.transform(F.split(F.reverse(digits), ""), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        x.cast("int") * 2 - F.when(x.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(d, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def rule(kind: str, s: Column) -> Column:
    """Whether a match passes its kind's rule (for the looser kinds: the weak label)."""
    n = F.length(_digits(s))
    if kind == "ip":
        return s.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}$")
    if kind == "card":
        return F.when(n.between(12, 19), luhn(_digits(s))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "number":
        return n.between(9, 15) & s.rlike("[().-]") | F.when(n.between(13, 19), luhn(_digits(s))).otherwise(False)
    if kind == "secret":
        return s.rlike("(?i)^(?:password|passwd|pwd|secret|token|api[_-]?key)") | (n >= 4) & s.rlike("[A-Za-z].*[A-Za-z].*[A-Za-z]")
    return F.lit(True)


def candidates(text: Column, kind: str) -> Column:
    """array<struct<kind, start, end, good, features...>> of one kind, by start."""
    clean = F.translate(F.coalesce(text, F.lit("")), SEP, STAND_IN)
    parts = F.split(F.regexp_replace(clean, PATTERNS[kind], SEP + "$0" + SEP), SEP, -1)
    k = KINDS.index(kind)
    shape = "array<struct<kind:int,start:int,end:int,good:boolean,digits:int,separators:int,size:int,keyword:int,edge:int,mixed:int,form:int,fold:int>>"
    none = F.array().cast(shape)

    def found(parts):
        def span(i, at):
            s, before, after = F.get(parts, i), F.get(parts, i - 1), F.get(parts, i + 1)
            return F.struct(
                F.lit(k).alias("kind"), at.alias("start"), (at + F.length(s)).alias("end"), rule(kind, s).alias("good"),
                _bucket(F.length(_digits(s)), (1, 4, 9, 13, 20)).alias("digits"),
                _bucket(F.length(F.regexp_replace(s, "[A-Za-z0-9]", "")), (1, 2, 4)).alias("separators"),
                _bucket(F.length(s), (9, 14, 20, 40)).alias("size"),
                F.right(before, F.lit(CONTEXT)).rlike(KEYWORD).cast("int").alias("keyword"),
                ((before == "") | before.rlike("\\s$")).cast("int").alias("edge"),
                (s.rlike("[A-Za-z]") & s.rlike("[0-9]")).cast("int").alias("mixed"),
                F.when(s.rlike("[=:]"), 2).otherwise(s.rlike("^[A-Z0-9]+$").cast("int")).alias("form"),
                (F.crc32(s) % 2).cast("int").alias("fold"))

        def step(acc, p):
            hit = acc["i"] % 2 == 1
            return F.struct((acc["at"] + F.length(p)).alias("at"), (acc["i"] + 1).alias("i"),
                            F.when(hit, F.concat(acc["spans"], F.array(span(acc["i"], acc["at"])))).otherwise(acc["spans"]).cast(shape).alias("spans"))

        return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), none.alias("spans")), step)["spans"]

    hit = F.lit(True) if kind not in NEEDS else F.contains(text, F.lit(NEEDS[kind]))
    # the split text is bound once (a one-element array) so that it isn't computed for every use
    bound = F.flatten(F.transform(F.array(parts), lambda p: F.when(F.size(p) > 1, found(p)).otherwise(none)))
    return F.when(hit, bound).otherwise(none)


def with_candidates(docs: DataFrame, text_col: str = "text", out: str = "_candidates") -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.withColumn(out, F.concat(*[candidates(text, k) for k in KINDS]))


# ------------------------------------------------------------------ trees

def _predicates() -> list[tuple[str, str, int]]:
    """Binary questions (feature, operator, value) that the trees may ask."""
    out = [("kind", "=", v) for v in range(len(KINDS))]
    return out + [(f, ">=", v) for f, n in FEATURES.items() if f != "kind" for v in range(1, n)]


def _holds(cell: dict, p: tuple[str, str, int]) -> bool:
    return cell[p[0]] == p[2] if p[1] == "=" else cell[p[0]] >= p[2]


def boost(cells: list[dict], rounds: int = 24, rate: float = 0.4, ridge: float = 1.0) -> list[tuple]:
    """Depth-two trees (p, (q, a, b), (r, c, d)) fitted to log loss by Newton steps.

    ``cells`` hold features, ``pos`` and ``neg`` counts: sufficient for all candidates.
    """
    asked = _predicates()
    yes = [[_holds(c, p) for c in cells] for p in asked]
    score, trees = [0.0] * len(cells), []

    def leaf(rows, g, h):
        return rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + ridge)

    def split(rows, g, h):
        best = (-1.0, 0, rows, [])
        for j in range(len(asked)):
            a, b = [i for i in rows if yes[j][i]], [i for i in rows if not yes[j][i]]
            gain = sum(sum(g[i] for i in s) ** 2 / (sum(h[i] for i in s) + ridge) for s in (a, b))
            if gain > best[0] + 1e-12:
                best = (gain, j, a, b)
        return best[1:]

    for _ in range(rounds if cells else 0):
        p = [1 / (1 + math.exp(-max(-30.0, min(30.0, s)))) for s in score]
        g = [c["pos"] - (c["pos"] + c["neg"]) * q for c, q in zip(cells, p)]
        h = [(c["pos"] + c["neg"]) * q * (1 - q) for c, q in zip(cells, p)]
        j, a, b = split(range(len(cells)), g, h)
        sides = []
        for rows in (a, b):
            k, m, n = split(rows, g, h)
            sides.append((asked[k], leaf(m, g, h), leaf(n, g, h)))
            for i in m:
                score[i] += sides[-1][1]
            for i in n:
                score[i] += sides[-1][2]
        trees.append((asked[j], *sides))
    return trees


def cell_score(cell: dict, trees: list[tuple]) -> float:
    total = 0.0
    for p, a, b in trees:
        q, x, y = a if _holds(cell, p) else b
        total += x if _holds(cell, q) else y
    return total


def calibrate(cells: list[dict], trees: list[tuple], precision: float = 0.9) -> dict[int, float]:
    """Per extra kind the lowest score at which more than half of the candidates are good, while all at or
    above it reach the precision."""
    out = {}
    for k, kind in enumerate(KINDS):
        scored = sorted(((round(cell_score(c, trees), 9), c) for c in cells if c["kind"] == k and kind in EXTRA), key=lambda x: -x[0])
        pos = neg = 0
        for s, same in groupby(scored, key=lambda x: x[0]):
            counts = [(c["pos"], c["neg"]) for _, c in same]
            p, n = sum(x for x, _ in counts), sum(x for _, x in counts)
            pos, neg = pos + p, neg + n
            if p > n and pos >= precision * (pos + neg):
                out[k] = s - 1e-9
    return out


def fit(candidates_table: DataFrame, column: str = "_candidates", **options) -> tuple[list[tuple], dict[int, float]]:
    """Trees and thresholds from the counts of all candidates (at most ``CELLS`` rows reach the driver)."""
    features = list(FEATURES)
    each = candidates_table.select(F.explode(apart(F.col(column))).alias("c")).select("c.*")
    counts = each.groupBy("fold", *features).agg(F.count_if("good").alias("pos"), F.count_if(~F.col("good")).alias("neg"))
    rows = [r.asDict() for r in counts.orderBy("fold", *features).collect()]
    trees = boost([r for r in rows if r["fold"] == 0], **options)
    return trees, calibrate([r for r in rows if r["fold"] == 1], trees)


def score(c: Column, trees: list[tuple]) -> Column:
    def asks(p):
        return c[p[0]] == p[2] if p[1] == "=" else c[p[0]] >= p[2]

    total = F.lit(0.0)
    for p, (q, a, b), (r, x, y) in trees:
        total = total + F.when(asks(p), F.when(asks(q), a).otherwise(b)).otherwise(F.when(asks(r), x).otherwise(y))
    return total


def apart(column: Column) -> Column:
    """Base candidates, and the extra ones that don't overlap a passing base span."""
    base = F.filter(column, lambda c: (c["kind"] < len(BASE)) & c["good"])
    return F.filter(column, lambda c: (c["kind"] < len(BASE)) | ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))


def chosen(column: Column, model: tuple[list[tuple], dict[int, float]]) -> Column:
    """Base spans that pass, and the extra candidates apart from them that the trees select; by
    start, then kind."""
    trees, thresholds = model


    def keep(c):
        extra = F.lit(False)
        for k, t in thresholds.items():
            extra = extra | (c["kind"] == k) & (score(c, trees) >= t)
        return F.when(c["kind"] < len(BASE), c["good"]).otherwise(extra)

    narrow = F.transform(F.filter(apart(column), keep), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return F.array_sort(narrow)


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_spans per row.

    Null text counts as empty: no spans.  Rows are independent given the model, which is fitted to
    the candidates of all rows; repeated rows and null ids stay, other columns are not read;
    no rows give no rows (and a model that adds nothing).
    """
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    table = materialize(with_candidates(narrow).select("id", "_candidates"), "pii-candidates")
    spans = table.select("id", chosen(F.col("_candidates"), fit(table)).alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return spans.select(F.col("id").alias(id_col), *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; same columns and rows.

    Overlapping spans are replaced together, under the first one's kind.  Texts without spans,
    null texts included, stay as they are.  ``length_col``, if present, follows the text.  Other columns pass
    through whatever their names (rows travel under numbered names); repeated rows stay; no rows give no rows.
    """
    names, given = docs.columns, docs.schema
    rows = docs.toDF(*[f"_r{i}" for i in range(len(names))])
    text = F.col(f"_r{names.index(text_col)}")
    model = fit(materialize(with_candidates(rows.select(text.alias("text"))).select("_candidates"), "pii-candidates"))
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(kinds, s["kind"]))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    marked = with_candidates(rows, f"_r{names.index(text_col)}").withColumn("_spans", chosen(F.col("_candidates"), model))
    some = F.size("_spans") > 0
    out = marked.withColumn("_redacted", F.when(some, done).otherwise(text))
    cols = []
    for i, c in enumerate(names):
        if i == names.index(text_col):
            cols.append(F.col("_redacted").alias(c))
        elif c == length_col:
            cols.append(F.when(some, F.length("_redacted")).otherwise(F.col(f"_r{i}")).cast(given[i].dataType).alias(c))
        else:
            cols.append(F.col(f"_r{i}").alias(c))
    return out.select(*cols)
