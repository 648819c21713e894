"""Personal data by candidate gradient boosting, in DataFrame functions only.

Four strict generators give the base spans, which always stay. High-recall generators propose
further spans that may overlap those and each other: anything like an address, also a disguised
one ("x (at) y (dot) org"), anything like a grouped number, and within it the usual shapes of a card,
a dotted quad and a telephone number. Boosted trees score every proposal by its form and context. What the strict
patterns accepted is the positive class; what a rule refutes (a checksum that fails, a part above
255, too few digits, a plain number without any cue) is the negative one. All other
proposals have no label: strict patterns refuse them for their notation or their neighbours only (no
plus sign, a disguise, two cards in one run of digits), so the features leave the notation out.

Thresholds are calibrated for each kind on documents that the trees did not see: the lowest score from
which on the share of positives is at least ``PRECISION``, as is the score's probability. Unrefuted proposals above it that touch no base span are added, with kinds of their own.

Every feature has a few bins, so the corpus is reduced by one aggregation to counts per
feature vector (at most 73,728 of them), on which the trees are fitted; they are then
applied as one column expression.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base kinds in order, with patterns: fixed values. Written without backtracking (possessive
#: repeats; a match begins where a run begins or the last match ended), which finds the same spans.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IP_PARTS = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"
#: Proposals: addresses, numbers in groups, and the shapes of cards, quads and telephone numbers.
LIKE_EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++"
              r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++")
LIKE_NUMBER = r"(?<![A-Za-z0-9])\+?\(?[0-9](?:[ ().-]{0,2}[0-9])++(?![A-Za-z0-9])"
LIKE_CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])"
LIKE_IP = r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9])"
LIKE_PHONE = (r"(?<![0-9])(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_GENERATORS = (("_mail", LIKE_EMAIL), ("_number", LIKE_NUMBER), ("_card", LIKE_CARD), ("_quad", LIKE_IP),
               ("_call", LIKE_PHONE))
CUES = {
    "email_like": r"(?i)(mail|contact|address|write|reach)\W{0,3}\w*\W*$",
    "ip_like": r"(?i)(host|server|address|\bip)\W{0,3}\w*\W*$",
    "card_like": r"(?i)(card|visa|account|payment|number)\W{0,3}\w*\W*$",
    "phone_like": r"(?i)(phone|tel|call|fax|mobile|number)\W{0,3}\w*\W*$",
}
KINDS = tuple(CUES)

_DIGITS_OF = "length(regexp_replace(x.value, '[^0-9]', ''))"
#: (feature, SQL over the span struct ``x``, number of bins). A value is read without its plus sign and with
#: an address's disguise undone, so that notation decides nothing.
FEATURES = [
    ("kind_no", "array_position(array(" + ", ".join(f"'{k}'" for k in KINDS) + "), x.kind) - 1", len(KINDS)),
    ("digits", f"least(5, cast(floor({_DIGITS_OF} / 4) as int))", 6),
    ("gaps", "case when x.kind = 'email_like' then 0 else least(3, length(regexp_replace(x.value, '[^ ()-]', ''))) end", 4),
    ("dots", r"least(3, length(regexp_replace(regexp_replace(x.value, r'[(\[]dot[)\]]', '.'), '[^.]', '')))", 4),
    ("sound", "int(x.sound)", 2),
    ("cue", "int(case x.kind " + " ".join(f"when '{k}' then x.before rlike r'{c}'" for k, c in CUES.items()) + " end)", 2),
    ("open_end", "cast(x.after rlike '^[A-Za-z0-9@/:=_]' as int)", 2),
    ("group", "case when x.value rlike '[0-9]{9}' then 2 when x.value rlike '[0-9]{4}' then 1 else 0 end", 3),
    ("word_before", "cast(x.before rlike '[A-Za-z0-9]$' as int)", 2),
    ("letters", "least(3, cast(floor(length(regexp_replace(x.value, '[^A-Za-z]', '')) / 8) as int))", 4),
]
ROUNDS, DEPTH, RATE = 40, 3, 0.3
PRECISION = 0.9
#: Labelled proposals that the calibration of a kind needs, with fewer the threshold of all kinds holds; and
#: positives above a threshold (or all).
LEAST_SUPPORT = 20
_BLOCK = 512


def _spans(rows: DataFrame, name: str, pattern: str, only_if) -> DataFrame:
    """Adds ``name``: array of (start, end, value, before, after) of a pattern's matches.

    Matches are marked by two control characters (the text's own ones are blanked by a third)
    and cut out; running sums of the pieces' lengths give code points. The sums are taken in
    blocks, so that many matches in one text stay cheap.
    """
    p, s = f"_{name}_parts", f"_{name}_starts"
    marked = F.regexp_replace("_clean", F.lit(pattern), F.lit("\u0001$0\u0002"))
    rows = rows.withColumn(p, F.when(only_if, F.split(marked, "[\u0001\u0002]")))
    rows = rows.withColumn(s, F.expr(f"""
        case when size({p}) > 1 then flatten(aggregate(
          sequence(0, (size({p}) - 1) div {_BLOCK}),
          named_struct('at', 0, 'out', cast(array() as array<array<int>>)),
          (a, b) -> named_struct(
            'at', a.at + aggregate(slice({p}, b * {_BLOCK} + 1, {_BLOCK}), 0, (n, x) -> n + length(x)),
            'out', array_append(a.out, aggregate(
              slice({p}, b * {_BLOCK} + 1, {_BLOCK}),
              named_struct('at', a.at, 'out', cast(array() as array<int>)),
              (n, x) -> named_struct('at', n.at + length(x), 'out', array_append(n.out, n.at)),
              n -> n.out))),
          a -> a.out)) end"""))
    return rows.withColumn(name, F.expr(f"""
        case when size({p}) > 1 then transform(sequence(1, size({p}) - 2, 2), i -> named_struct(
          'start', {s}[i], 'end', {s}[i] + length({p}[i]), 'value', {p}[i],
          'before', right({p}[i - 1], 24), 'after', left({p}[i + 1], 8)))
        else cast(array() as array<struct<start: int, end: int, value: string, before: string,
                                          after: string>>) end""")).drop(p, s)


_LUHN = """aggregate(
    sequence(1, length(regexp_replace(x.value, '[^0-9]', ''))), 0, (n, i) -> n + case
      when i % 2 = 1 then int(substr(regexp_replace(x.value, '[^0-9]', ''), -i, 1))
      when substr(regexp_replace(x.value, '[^0-9]', ''), -i, 1) > '4'
        then 2 * int(substr(regexp_replace(x.value, '[^0-9]', ''), -i, 1)) - 9
      else 2 * int(substr(regexp_replace(x.value, '[^0-9]', ''), -i, 1)) end) % 10 = 0"""
BASE = [
    ("email", EMAIL, "true"),
    ("ip", IP, f"x.value rlike r'{IP_PARTS}'"),
    ("card", CARD, f"case when {_DIGITS_OF} between 13 and 19 then {_LUHN} else false end"),
    ("phone", PHONE, f"{_DIGITS_OF} between 9 and 15"),
]
#: Kinds of added spans, by form.
_KIND = """case when x.value like '%@%' or x.value rlike '[A-Za-z]' then 'email_like'
    when size(split(x.value, '[.]')) = 4 and x.value not like '% %' then 'ip_like'
    when length(regexp_replace(x.value, '[^0-9]', '')) >= 13 then 'card_like' else 'phone_like' end"""
#: Whether the value itself holds what its kind asks for: a last label of letters, parts up to 255, a
#: checksum, a number of digits.
_SOUND = rf"""case x.kind
    when 'email_like' then x.value rlike r'(\.|[(\[]dot[)\]]) ?[A-Za-z]{{2,}}$'
    when 'ip_like' then x.value rlike r'{IP_PARTS}'
    when 'card_like' then {_DIGITS_OF} between 13 and 19 and {_LUHN}
    else {_DIGITS_OF} between 9 and 12 end"""
#: 1: a base span, 0: refuted, null: neither.
_LABEL = f"""case
    when array_contains(_base, named_struct('start', x.start, 'end', x.end)) then 1
    when not x.sound then 0
    when x.kind = 'phone_like' and x.value not like '+%' and not x.before rlike r'{CUES["phone_like"]}' then 0 end"""


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with arrays of base spans (email, ip, card, phone) and ``proposals``.

    A proposal has its features and ``label``: 1 if a base span is exactly there, 0 if a rule refutes it.
    """
    rows = docs.withColumn("_clean", F.translate(F.coalesce("text", F.lit("")), "\u0001\u0002", "\u0003\u0003"))
    rows = rows.withColumn("_digit", F.col("_clean").rlike("[0-9]"))
    for kind, pattern, valid in BASE:
        needed = F.col("_clean").contains("@") if kind == "email" else F.col("_digit")
        if kind == "phone":
            needed = needed & F.col("_clean").contains("+")
        rows = _spans(rows, kind, pattern, needed)
        rows = rows.withColumn(kind, F.expr(f"filter({kind}, x -> {valid})"))
    for name, pattern in _GENERATORS:
        needed = F.col("_digit")
        if name == "_mail":
            needed = F.col("_clean").contains("@") | F.col("_clean").rlike(r"[(\[]at[)\]]")
        rows = _spans(rows, name, pattern, needed)
    # columns are read twice below where the planner must not inline them into a lambda
    rows = rows.withColumn("_base", F.expr(
        "transform(concat(email, ip, card, phone), x -> named_struct('start', x.start, 'end', x.end))"))
    every = ", ".join(n for n, _ in _GENERATORS)
    rows = rows.withColumn("_kinds", F.expr(f"""
        transform(filter(array_distinct(concat({every})), x -> x.value like '%@%' or x.value rlike '[A-Za-z]'
                         or {_DIGITS_OF} >= 7),
          x -> named_struct('kind', {_KIND}, 'start', x.start, 'end', x.end, 'value', x.value,
                            'before', x.before, 'after', x.after))"""))
    rows = rows.withColumn("_sound", F.expr(f"""
        transform(_kinds, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'value', x.value,
                  'before', x.before, 'after', x.after, 'sound', coalesce({_SOUND}, false)))"""))
    fields = ", ".join(f"'{n}', int({e})" for n, e, _ in FEATURES)
    return rows.withColumn("proposals", F.expr(f"""
        transform(_sound, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'label', {_LABEL}, {fields}))"""
    )).drop("_clean", "_digit", "_kinds", "_sound", *(n for n, _ in _GENERATORS))


def fit_trees(vectors: np.ndarray, positive: np.ndarray, negative: np.ndarray,
              rounds: int = ROUNDS, depth: int = DEPTH) -> list:
    """Boosted trees for the logistic loss on counted feature vectors.

    A tree is (feature, bin, left, right), left for values up to the bin, or a number.
    """
    total = positive + negative
    share = min(max(positive.sum() / max(total.sum(), 1), 1e-3), 1 - 1e-3)
    score = np.full(len(vectors), math.log(share / (1 - share)))
    trees: list = [float(score[0])] if len(vectors) else [-10.0]

    def grow(rows, level, grad, curve):
        def gain(g, h):
            return g * g / (h + 1.0)

        g, h = grad[rows].sum(), curve[rows].sum()
        best = (1e-6, None, None)
        if level < depth:
            for f, (_, _, bins) in enumerate(FEATURES):
                for b in range(bins - 1):
                    left = rows & (vectors[:, f] <= b)
                    gl, hl = grad[left].sum(), curve[left].sum()
                    more = gain(gl, hl) + gain(g - gl, h - hl) - gain(g, h)
                    if left.any() and (rows & ~left).any() and more > best[0]:
                        best = (more, f, b)
        if best[1] is None:
            return float(RATE * g / (h + 1.0))
        left = rows & (vectors[:, best[1]] <= best[2])
        return (best[1], best[2], grow(left, level + 1, grad, curve),
                grow(rows & ~left, level + 1, grad, curve))

    for _ in range(rounds if len(vectors) else 0):
        p = 1 / (1 + np.exp(-score))
        tree = grow(np.ones(len(vectors), bool), 0, positive - total * p, total * p * (1 - p))
        trees.append(tree)
        score = score + _apply(tree, vectors)
    return trees


def _apply(tree, vectors):
    if not isinstance(tree, tuple):
        return np.full(len(vectors), tree)
    f, b, left, right = tree
    return np.where(vectors[:, f] <= b, _apply(left, vectors), _apply(right, vectors))


def _sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"{tree:.9f}D"
    f, b, left, right = tree
    return f"case when x.{FEATURES[f][0]} <= {b} then {_sql(left)} else {_sql(right)} end"


def fit(found: DataFrame):
    """(trees, thresholds by kind) from ``candidates``: fitted on half of the texts, calibrated on the other."""
    code = "0L"  # a feature vector as one number, and whether it is positive
    for name, _, bins in FEATURES:
        code = f"({code}) * {bins} + x.{name}"
    labelled = F.expr(f"transform(filter(proposals, x -> x.label is not null), x -> 2 * ({code}) + x.label)")
    counts = (found.select(F.explode(labelled).alias("code"), F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"))
              .groupBy("half", "code").count().orderBy("half", "code").collect())

    def part(half):
        both: dict[int, list[int]] = {}
        for r in counts:
            if r.half == half:
                both.setdefault(r.code // 2, [0, 0])[r.code % 2] += r["count"]
        vectors = np.zeros((len(both), len(FEATURES)), int)
        rest = np.array(list(both), int)
        for f in reversed(range(len(FEATURES))):
            vectors[:, f], rest = rest % FEATURES[f][2], rest // FEATURES[f][2]
        no, yes = np.array(list(both.values()), float).reshape(-1, 2).T
        return vectors, yes, no

    trees = fit_trees(*part(0))
    vectors, yes, no = part(1)
    score = sum((_apply(t, vectors) for t in trees), np.zeros(len(vectors)))
    pooled = _threshold(score, yes, no)
    own = vectors[:, 0]
    return trees, {kind: pooled if (yes + no)[own == k].sum() < LEAST_SUPPORT else
                   _threshold(score[own == k], yes[own == k], no[own == k]) for k, kind in enumerate(KINDS)}


def _threshold(score, yes, no) -> float:
    """From where on positives have the share ``PRECISION``, in the middle between the last score for which that
    holds and the next below, and that means at least this probability; infinite where it holds for too few
    positives."""
    seen = sorted(set(score.tolist()))
    for k, s in enumerate(seen):
        above = score >= s
        if yes[above].sum() >= max(PRECISION * (yes + no)[above].sum(), min(LEAST_SUPPORT, yes.sum()), 1):
            return max(math.log(PRECISION / (1 - PRECISION)), (seen[k - 1] + s) / 2 if k else -math.inf)
    return math.inf


def find_pii(docs: DataFrame, model=None) -> DataFrame:
    """``docs`` with ``found``: all spans (kind, start, end), the base spans by kind, and ``scored``: every
    proposal that touches no base span (kind, start, end, score from 0 to 1, added).

    Positions are code points, ends exclusive. A null text counts as empty and has no spans.
    Spans come by kind (email, ip, card, phone, then the added kinds by name), then start. Of added
    spans that overlap the best scored stays (ties: the first, then the longest).
    Without proposals in the corpus, or if no threshold is precise enough, nothing is added.
    Rows are independent, so repeated ones have equal results; the other columns stay, but
    those that are called as the added ones.
    """
    added = ("email", "ip", "card", "phone", "proposals", "found", "scored")
    # columns that begin with an underscore are put out of the way of the helpers' names
    kept = [c for c in docs.columns if c not in added]
    away = {c: f"kept{k}{c}" for k, c in enumerate(kept) if c.startswith("_")}
    docs = docs.select(*[F.col(f"`{c}`").alias(away.get(c, c)) for c in kept])
    rows = candidates(docs)
    trees, thresholds = model or fit(candidates(docs.select("doc_id", "text")))
    total = " + ".join(f"({_sql(t)})" for t in trees)
    least = "case x.kind " + " ".join(
        f"when '{k}' then {thresholds[k] - 1e-9:.9f}D" for k in KINDS if math.isfinite(thresholds.get(k, math.inf))
    ) + " else double('infinity') end" if any(map(math.isfinite, thresholds.values())) else "double('infinity')"
    rows = rows.withColumn("_free", F.expr(f"""
        transform(filter(proposals, x -> x.label is null or x.label <> 1),
          x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'logit', {total},
                            'open', x.label is null and not exists(_base, b -> b.start < x.end and x.start < b.end),
                            'least', {least}))"""))
    rows = rows.withColumn("_good", F.expr("filter(_free, x -> x.open and x.logit >= x.least)"))
    best = """filter(_good, x -> not exists(_good, y -> y.start < x.end and x.start < y.end and (
        y.logit > x.logit or (y.logit = x.logit and (y.start < x.start or (y.start = x.start and y.end > x.end))))))"""
    rows = rows.withColumn("_best", F.expr(
        f"array_sort(transform({best}, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end)))"))
    base = ", ".join(f"transform({k}, x -> named_struct('kind', '{k}', 'start', x.start, 'end', x.end))"
                     for k, _, _ in BASE)
    scored = """array_sort(transform(filter(_free, x -> not exists(_base, b -> b.start < x.end and x.start < b.end)),
        x -> named_struct('start', x.start, 'end', x.end, 'kind', x.kind,
          'score', 1 / (1 + exp(-x.logit)),
          'added', array_contains(_best, named_struct('kind', x.kind, 'start', x.start, 'end', x.end)))))"""
    out = rows.withColumn("found", F.expr(f"concat({base}, _best)")).withColumn("scored", F.expr(scored))
    back = {v: k for k, v in away.items()}
    return out.drop("proposals", "_base", "_free", "_good", "_best").select(
        *[F.col(f"`{back.get(c, c)}`") if c not in back else F.col(f"`{c}`").alias(back[c])
          for c in [*docs.columns, "email", "ip", "card", "phone", "found", "scored"]])


def pii_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) per row of ``docs``.

    ``scores``: kind:start:end:score of every proposal without a label that touches no base span, by start;
    a plus behind those that were added.
    """
    def joined(where):
        return F.expr(f"array_join(transform({where}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")

    rows = find_pii(docs.select("doc_id", "text"))
    listed = ", ".join(f"'{k}'" for k, _, _ in BASE)
    return rows.select(
        "doc_id", *(F.size(k).cast("bigint").alias(f"n_{k}") for k, _, _ in BASE),
        F.sha2(joined(f"filter(found, x -> x.kind in ({listed}))"), 256).alias("base_sha256"),
        joined("found").alias("spans"),
        F.expr("""array_join(transform(scored, x -> concat(x.kind, ':', x.start, ':', x.end, ':',
            format_number(x.score, 3), if(x.added, '+', ''))), ',')""").alias("scores"))


def redact(docs: DataFrame, model=None) -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in brackets.

    Of spans that overlap, the first one's kind stands for all. Null texts stay null.
    """
    rows = find_pii(docs, model).withColumn("found", F.expr(
        "array_sort(transform(found, x -> named_struct('start', x.start, 'end', x.end, 'kind', x.kind)))"))
    text = F.expr("""aggregate(found, named_struct('at', 0, 'out', cast(array() as array<string>)),
        (a, x) -> case
          when x.start < a.at then named_struct('at', greatest(a.at, x.end), 'out', a.out)
          else named_struct('at', x.end, 'out', concat(a.out, array(
            substr(text, a.at + 1, x.start - a.at), concat('[', x.kind, ']')))) end,
        a -> concat(array_join(a.out, ''), substr(text, a.at + 1)))""")
    return rows.withColumn("text", text).select(*docs.columns)
