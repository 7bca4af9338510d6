"""Personal data by weak supervision, in DataFrame functions only.

1. Candidates: one scan of the texts splits each at the matches of every
   pattern; a running sum of piece lengths (a window per text over its own
   matches) gives code-point offsets. Patterns are possessive or anchored at
   run starts, so a long run of letters or digits costs linear time.
2. Labelers vote on each candidate: regex shape and checksum labelers, gazetteer
   labelers (reserved networks, card prefixes, key prefixes, sample domains)
   and context labelers (words before the span). A vote is 1 (personal), -1
   (not) or 0 (abstains).
3. Expectation-maximisation over the counted vote patterns estimates each
   labeler's reliability and every kind's prior; no labels are needed. The
   count table has at most kinds x 3^labelers rows, however large the input.
4. A logistic span classifier is trained on all candidates, aggregated by their
   discrete features (again a bounded table) with the posteriors as soft
   targets, and scores every candidate by a native expression.

Base matches (email, ip, card, phone that pass their checks) always stay; the
method adds spans of kinds ``local_phone``, ``secret`` and ``ssn`` whose
probability is at least ``threshold`` and that overlap no base span. Their
patterns are loose (any run of 7 to 11 digits, any token of 20 or more letters
and digits), so most candidates are for the model to reject.

Defined cases: NULL text is empty and has no span; empty tables give empty
results; repeated rows each get their own row of results; a NULL id is kept.
Only the id and text columns are read. Very long texts are one row each: their
matches, not their characters, are what the window sorts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.common import stage_table, texts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("local_phone", "secret", "ssn")
LOCAL = r"A-Za-z0-9._%+-"
#: What names a secret (``token=``, ``token = ``, ``"token": ``) and its value: a
#: quoted one ends before its closing quote on the same line, any other one at
#: white space. Neither has a longest length.
SECRET_NAME = r"""(?i:password|passwd|pwd|secret|token|api_?key)["']?+\s*+[=:]\s*+"""
SECRET_VALUE = (r"""(?:"(?:[^"\\\r\n]|\\[^\r\n]){6,}+(?=")|'(?:[^'\\\r\n]|\\[^\r\n]){6,}+(?=')"""
                r"""|["']?+[^\s]{6,}+)""")
BARE_TOKEN = r"(?<!-)(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{20,}+"
#: Java patterns. The four base kinds equal their plain forms: local parts and
#: digit runs can only match from the run's start or where the last match
#: ended, and possessive loops never need to give back.
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Added kinds are loose: bare digit runs and bare tokens of letters and
    # digits are candidates too, and the model decides which ones stay.
    "local_phone": r"(?<![0-9+(.-])(?<!\+[0-9]{1,3}[ .-]?)(?:(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
                   r"|[0-9]{7,11})(?![0-9])",
    "secret": rf"(?<![A-Za-z0-9_])(?:{SECRET_NAME}{SECRET_VALUE}|A[KS]IA[A-Z0-9]{{16}}(?![A-Za-z0-9])|{BARE_TOKEN})",
    "ssn": r"(?<![0-9-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{9})(?![0-9-])",
}
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
CONTEXT_CHARS = 32
ITERATIONS = 40


def _luhn(digits: Column) -> Column:
    """Luhn sum divisible by ten (strings of at most 19 digits)."""
    def add(acc, x):
        d = x["d"].cast("int") * (x["i"] % 2 + 1)
        return acc + F.when(d > 9, d - 9).otherwise(d)
    rev = F.split(F.reverse(digits), "")
    places = F.transform(rev, lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    return F.aggregate(F.filter(places, lambda x: x["d"] != ""), F.lit(0), add) % 10 == 0


def _hit_of(kind: str):
    return lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), x["v"].alias("value"), F.length(x["g"]).alias("gap"),
        F.substring(x["g"], -CONTEXT_CHARS, CONTEXT_CHARS).alias("before"),
        F.substring(x["a"], 1, 8).alias("after"))


def candidates(rows: DataFrame) -> DataFrame:
    """(rid, kind, start, end, value, before, after) of every pattern match in
    rows (rid, text); end is exclusive, both count code points."""
    may = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+"),
           "secret": F.col("text").rlike("(?i)password|passwd|pwd|secret|token|api_?key|A[KS]IA|[A-Za-z0-9_-]{20}")}
    found = rows
    for kind, p in PATTERNS.items():
        test = may.get(kind, F.col("text").rlike("[0-9]"))
        none = F.array().cast("array<string>")
        found = found.withColumn(f"v_{kind}", F.when(test, F.regexp_extract_all("text", F.lit(p), F.lit(0)))
                                 .otherwise(none))
    for kind, p in PATTERNS.items():
        found = found.withColumn(f"g_{kind}", F.when(F.size(f"v_{kind}") > 0, F.split("text", p, -1))
                                 .otherwise(F.array().cast("array<string>")))
    parts = []
    for kind in PATTERNS:
        g = F.col(f"g_{kind}")
        zipped = F.arrays_zip(F.col(f"v_{kind}").alias("v"), g.alias("g"),
                              F.slice(g, F.lit(2), F.greatest(F.size(g), F.lit(1))).alias("a"))
        parts.append(F.transform(zipped, _hit_of(kind)))
    hits = found.select("rid", F.explode(F.concat(*parts)).alias("x")).select("rid", "x.*")
    hits = hits.filter("value IS NOT NULL")
    upto = Window.partitionBy("rid", "kind").orderBy("i")
    size = F.length("value")
    end = F.sum(F.col("gap") + size).over(upto)
    return hits.select("rid", "kind", (end - size).cast("bigint").alias("start"),
                       end.cast("bigint").alias("end"), "value", "before", "after")


def _shape(df: DataFrame) -> DataFrame:
    """Digits, the base rules' verdict and whether the span is a base one."""
    df = df.withColumn("digits", F.regexp_replace("value", "[^0-9]", ""))
    n = F.length("digits")
    ok = (F.when(F.col("kind") == "email", F.lit(True))
          .when(F.col("kind") == "ip", F.col("value").rlike(IP_PARTS))
          .when(F.col("kind") == "card", n.between(13, 19) & _luhn(F.substring("digits", 1, 19)))
          .when(F.col("kind") == "phone", n.between(9, 15)).otherwise(F.lit(False)))
    return df.withColumn("base", ok)


CONTEXT_WORDS = {
    "email": "mail|contact|write|reach", "ip": r"\bip\b|host|server|address|login",
    "card": "card|visa|credit|pay|iban|account", "phone": "phone|call|tel|mobile|fax|contact",
    "local_phone": "phone|call|tel|mobile|fax|contact", "secret": "key|aws|login|credential|user",
    "ssn": r"\bssn\b|social|security|tax",
}
#: Sample mail domains, networks that name no person's host, card issuer
#: prefixes, and prefixes of issued keys.
SAMPLE_DOMAINS = r"@(?:localhost|test|invalid)\b"
RESERVED_NETS = r"^(?:0|10|127|169\.254|192\.168|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
KEY_PREFIX = r"^(?:A[KS]IA|(?i:password|passwd|pwd|secret|token|api_?key))"


def _votes() -> dict[str, Column]:
    kind, value, digits = F.col("kind"), F.col("value"), F.col("digits")
    n = F.length(digits)
    one, no, none = F.lit(1), F.lit(-1), F.lit(0)

    def on(kinds, yes):
        return F.when(kind.isin(*kinds), F.when(yes, one).otherwise(no)).otherwise(none)

    # A run of digits without marks is most often a count or a number of something.
    bare = kind.isin("local_phone", "ssn") & ~value.rlike("[^0-9]")
    context = none
    for k, w in CONTEXT_WORDS.items():
        context = F.when((kind == k) & F.lower("before").rlike(w), one).otherwise(context)
    return {
        # regex and checksum labelers
        "lf_rule": F.when(kind.isin(*BASE_KINDS), F.when(F.col("base"), one).otherwise(no)).otherwise(none),
        "lf_count": F.when(kind == "card", F.when(n.between(13, 19), one).otherwise(no))
                     .when(kind.isin("phone", "local_phone"), F.when(n.between(9, 15), F.when(bare, none).otherwise(one))
                           .otherwise(no))
                     .when(kind == "ssn", F.when(digits.rlike("^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$"),
                                                 F.when(bare, none).otherwise(one)).otherwise(no)).otherwise(none),
        "lf_edges": F.when(F.col("before").rlike(r"[\p{L}0-9_]$") | F.col("after").rlike(r"^[\p{L}0-9_]"), no)
                     .otherwise(one),
        "lf_repeat": F.when((n >= 6) & digits.rlike(r"^([0-9])\1+$"), no).otherwise(none),
        # gazetteer labelers
        "lf_issuer": on(("card",), digits.rlike(CARD_PREFIX)),
        "lf_network": F.when((kind == "ip") & value.rlike(RESERVED_NETS), no)
                       .when((kind == "email") & value.rlike(SAMPLE_DOMAINS), no).otherwise(none),
        "lf_key": F.when((kind == "secret") & value.rlike(KEY_PREFIX),
                         F.when(F.length("value") >= 12, one).otherwise(none)).otherwise(none),
        # format labelers: bare runs and nameless tokens are most often neither
        "lf_format": F.when(kind.isin("local_phone", "ssn"), F.when(bare, no).otherwise(one))
                      .when(kind == "secret", F.when(value.rlike(KEY_PREFIX), one).otherwise(no)).otherwise(none),
        # context labelers
        "lf_context": context,
        "lf_number": F.when(bare & (context == 0), no).otherwise(none),
        "lf_sentence": F.when(F.col("before").rlike(r"(?:\p{L}+\p{P}?\s+)$|^$"), one).otherwise(none),
    }


def _features() -> dict[str, Column]:
    """Discrete features of a span, each with a handful of values."""
    n, size = F.length("digits"), F.length("value")
    char_class = lambda c: (F.when(c == "", "edge").when(c.rlike(r"^\s"), "space")
                            .when(c.rlike(r"^[\p{L}0-9]"), "word").otherwise("mark"))
    return {
        "kind": F.col("kind"),
        "size": F.when(size < 9, "s").when(size < 13, "m").when(size < 17, "l").when(size < 25, "xl").otherwise("xxl"),
        "digits": F.when(n == 0, "0").when(n < 9, "few").when(n < 13, "phone").when(n < 20, "card").otherwise("many"),
        "left": char_class(F.substring("before", -1, 1)),
        "right": char_class(F.substring("after", 1, 1)),
        "rule": F.col("base").cast("string"),
        "context": (F.col("lf_context") > 0).cast("string"),
        "format": F.col("lf_format").cast("string"),
        "known": F.when(F.col("lf_issuer") + F.col("lf_key") + F.col("lf_network") > 0, "yes")
                  .when(F.col("lf_issuer") + F.col("lf_key") + F.col("lf_network") < 0, "no").otherwise("none"),
    }


def em_reliabilities(counts: list[tuple[str, tuple[int, ...], int]], labelers: list[str],
                     iterations: int = ITERATIONS) -> dict:
    """Label model by expectation-maximisation: ``counts`` are (kind, votes,
    rows). Each labeler has one reliability, the share of its votes that are
    right (starting at 0.8, kept within 0.5 and 0.99); abstaining says nothing.
    Returns log-odds {"prior": {kind: x}, "vote": {(labeler, vote): x}} whose
    sum is the posterior log-odds that a span is personal data."""
    right = [0.8] * len(labelers)
    prior = {k: 0.5 for k, _, _ in counts}
    for _ in range(iterations):
        yes, rows = dict.fromkeys(prior, 1.0), dict.fromkeys(prior, 2.0)
        good, cast = [8.0] * len(labelers), [10.0] * len(labelers)
        for kind, votes, n in counts:
            s = math.log(prior[kind] / (1 - prior[kind])) + sum(
                v * math.log(right[j] / (1 - right[j])) for j, v in enumerate(votes))
            q = 1 / (1 + math.exp(-max(-500.0, min(500.0, s))))
            yes[kind] += q * n
            rows[kind] += n
            for j, v in enumerate(votes):
                if v:
                    good[j] += n * (q if v > 0 else 1 - q)
                    cast[j] += n
        prior = {k: min(0.99, max(0.01, yes[k] / rows[k])) for k in prior}
        right = [min(0.99, max(0.5, g / c)) for g, c in zip(good, cast, strict=True)]
    return {"prior": {k: math.log(x / (1 - x)) for k, x in prior.items()},
            "reliability": dict(zip(labelers, right, strict=True)),
            "vote": {(name, v): v * math.log(x / (1 - x))
                     for name, x in zip(labelers, right, strict=True) for v in (-1, 0, 1)}}


def fit_logistic(rows: list[tuple[tuple[str, ...], float, float]], steps: int = 150,
                 l2: float = 1.0) -> dict:
    """Weights {(place, value): w} and bias {None: b} of a logistic model on
    one-hot features from (features, rows, sum of soft targets); AdaGrad over
    the aggregated table, so its cost does not depend on the input's size."""
    total = sum(n for _, n, _ in rows) or 1.0
    w: dict = {None: 0.0}
    for f, _, _ in rows:
        for key in enumerate(f):
            w.setdefault(key, 0.0)
    g2 = dict.fromkeys(w, 1e-8)
    for _ in range(steps):
        grad = {k: l2 * x / total for k, x in w.items()}
        for f, n, t in rows:
            s = w[None] + sum(w[key] for key in enumerate(f))
            d = (n / (1 + math.exp(-max(-500.0, min(500.0, s)))) - t) / total
            grad[None] += d
            for key in enumerate(f):
                grad[key] += d
        for k, g in grad.items():
            g2[k] += g * g
            w[k] -= 0.5 * g / math.sqrt(g2[k])
    return w


def _lookup(col: Column, values: dict) -> Column:
    out = F.lit(0.0)
    for v, x in values.items():
        out = F.when(col == F.lit(v), F.lit(float(x))).otherwise(out)
    return out


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def find_pii(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id",
             text_col: str = "text") -> tuple[DataFrame, DataFrame, dict]:
    """(rows, spans, model): rows are (rid, doc_id) of every input row, spans
    (rid, kind, start, end, base, score), of which base ones and added ones
    from ``threshold`` on are kept."""
    rows = texts(docs, id_col, text_col)
    shaped = _shape(candidates(rows.select("rid", "text")))
    votes = _votes()
    voted = shaped.withColumns(votes)
    feats = _features()
    cands = stage_table(voted.select("rid", "kind", "start", "end", "base", *votes,
                                     *[c.alias(f"f_{k}") for k, c in feats.items()]), "pii-candidates")
    names = list(votes)
    counted = [(r[0], tuple(r[1:-1]), r[-1]) for r in cands.groupBy("kind", *names).count().collect()]
    model = em_reliabilities(counted, names)
    logit = _lookup(F.col("kind"), model["prior"])
    for name in names:
        logit = logit + _lookup(F.col(name), {v: model["vote"][name, v] for v in (-1, 0, 1)})
    fcols = [f"f_{k}" for k in feats]
    soft = (cands.withColumn("p", _sigmoid(logit)).groupBy(*fcols)
            .agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("t")).collect())
    model["weights"] = w = fit_logistic([(tuple(r[:-2]), float(r[-2]), float(r[-1])) for r in soft])
    score = F.lit(float(w[None]))
    for i, c in enumerate(fcols):
        score = score + _lookup(F.col(c), {v: x for key, x in w.items() if key and key[0] == i for v in [key[1]]})
    scored = cands.select("rid", "kind", "start", "end", "base", _sigmoid(score).alias("score"))
    # Added spans give way to base spans they overlap: the furthest end of the
    # base spans that begin before, and the nearest start of those that follow.
    own = Window.partitionBy("rid")
    before = own.orderBy("start", F.col("base").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = own.orderBy(F.col("start").desc(), "base").rowsBetween(Window.unboundedPreceding, -1)
    base_end = F.max(F.when(F.col("base"), F.col("end"))).over(before)
    base_start = F.min(F.when(F.col("base"), F.col("start"))).over(after)
    free = (F.coalesce(base_end, F.lit(-1)) <= F.col("start")) & (
        F.coalesce(base_start, F.lit(1 << 62)) >= F.col("end"))
    spans = scored.withColumn("free", free).filter(
        F.col("base") | (F.col("kind").isin(*ADDED_KINDS) & (F.col("score") >= threshold) & F.col("free")))
    return rows.select("rid", "doc_id"), spans.drop("free"), model


def pii_report(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: counts of base spans, their digest, all spans."""
    rows, spans, _ = find_pii(docs, threshold)
    place = _lookup(F.col("kind"), {k: i for i, k in enumerate([*BASE_KINDS, *sorted(ADDED_KINDS)])}).cast("int")
    entry = F.struct(place.alias("k"), "start", "end",
                     F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")).alias("s"),
                     "base", "score")
    per = spans.groupBy("rid").agg(
        F.array_sort(F.collect_list(entry)).alias("all"),
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE_KINDS])
    empty = F.array().cast("array<string>")
    listed = lambda a: F.coalesce(F.transform(a, lambda x: x["s"]), empty)
    return (rows.join(per, "rid", "left")
            .select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in BASE_KINDS],
                    F.sha2(F.array_join(listed(F.filter("all", lambda x: x["base"])), ",").cast("binary"), 256)
                    .alias("base_sha256"),
                    F.array_join(listed(F.col("all")), ",").alias("spans"),
                    F.coalesce(F.size(F.filter("all", lambda x: ~x["base"])).cast("bigint"), F.lit(0))
                    .alias("n_added")))
