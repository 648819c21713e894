"""Toxicity by weak supervision.

Voters say "toxic" or abstain: the words of a small public lexicon, patterns (shouting, exclaiming,
masked words), and words and word beginnings that labelled training rows hold almost only in toxic
texts. They vote on every text that may be learned from, labelled or not. A generative label model (a
latent class with an own rate of every voter in each class) is fitted to their votes alone by expectation
maximisation; voters that agree more often than their class explains are correlated, and their evidence is
discounted by it. Labels only name the classes. The posterior then labels a sample of texts: from it come
the terms of a linear classifier, among them those of toxic texts without a label, and its targets. The
classifier scores every text.

Votes are counted over all texts by the pattern they make; the sample is of at most about ``TRAIN_ROWS`` labelled and
``MORE_ROWS`` unlabelled rows; scoring reads whole texts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavlake.llm.language import held_out
from gavlake.llm.scratch import discard, ship_by_value, small_batches, staged
from gavlake.llm.text import SpanHasher, mix, runs, text_slices

#: Labelled rows that the models are fitted on, about; a hash of doc_id picks them.
TRAIN_ROWS = 20_000
#: Rows without a label in the classifier's sample, about.
MORE_ROWS = 10_000
#: Words and beginnings that are taken from labelled rows, for voters, and from the model's, for the classifier.
TERMS = 384
#: Least share of toxic texts among the labelled ones with a voter's term, and of such texts among the toxic ones.
VOTER_PRECISION, VOTER_SHARE = 0.93, 0.02
LEAST_DOCS, LEAST_PRECISION = 3, 0.6
#: Occurrences of a term in a text are told apart up to this number.
LEVELS = 4
#: Bytes of the word beginnings that are terms, besides whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
FOLDS, HELD_OUT = 5, 0
#: What the label model assumes: see ``LabelModel``.
SILENT, TRUST, RIGHT = 0.01, 1.0, 0.9
#: Common insults: fixed values.
LEXICON = ("clown", "creep", "disgusting", "dumb", "filth", "fool", "garbage", "hate", "idiot", "imbecile",
           "jerk", "loser", "moron", "pathetic", "scum", "stupid", "trash", "ugly", "vermin", "worthless")
PATTERNS = ("shouting", "exclaiming", "masked")


def lower_latin(raw):
    """Bytes with A-Z and the capitals of Latin-1 in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    out = table[raw]
    if len(out) > 1:
        capital = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        out[1:][capital] += 32
    return out


def _letters():
    table = np.zeros(256, bool)
    table[65:91] = table[97:123] = True
    table[128:] = True
    return table


def terms_of(raw, offsets, hasher):
    """(term, row) of all words and word beginnings; a row's come for each length in turn."""
    low = lower_latin(raw)
    starts, ends, first = runs(_letters()[low], offsets)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = [(mix(hasher(low, starts, ends)), row)]
    size = ends - starts
    for k in BEGINNINGS:
        long = size > k
        begin = starts[long]
        out.append((hasher(low, begin, begin + k) + np.uint64(k), row[long]))
    return np.concatenate([t for t, _ in out]), np.concatenate([r for _, r in out])


def word_term(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(mix(SpanHasher(1 << 10)(raw, np.array([0]), np.array([len(raw)])))[0])


def patterns_of(raw, offsets):
    """Flags (rows x PATTERNS) of each text."""
    def share(mask):
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)

    capital = (raw >= 65) & (raw <= 90)
    small = (raw >= 97) & (raw <= 122)
    odd = np.isin(raw, np.frombuffer(b"*#$%&@", np.uint8))
    return np.stack([share(capital) > np.maximum(share(small), 0.2), share(raw == 33) > 0.02,
                     share(odd) > 0.05], axis=1)


class Finder:
    """Which of the given terms the texts of a column hold."""

    def __init__(self, terms):
        self.order = np.argsort(np.array(terms, np.uint64))
        self.terms = np.array(terms, np.uint64)[self.order]
        self.hasher = SpanHasher()
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.terms & np.uint64(0xFFFF)).astype(np.int64)] = True

    def hits(self, column):
        """(rows, indices of terms, occurrences up to LEVELS, patterns) of the column."""
        rows, found, times, flags = [], [], [], []
        for first, raw, offsets in text_slices(column):
            term, row = terms_of(raw, offsets, self.hasher)
            maybe = np.flatnonzero(self.filter[(term & np.uint64(0xFFFF)).astype(np.int64)])
            if len(maybe) and len(self.terms):
                at = np.minimum(np.searchsorted(self.terms, term[maybe]), len(self.terms) - 1)
                same = self.terms[at] == term[maybe]
                pair, n = np.unique(row[maybe][same] * len(self.terms) + self.order[at[same]],
                                    return_counts=True)
                rows.append(pair // len(self.terms) + first)
                found.append(pair % len(self.terms))
                times.append(np.minimum(n, LEVELS))
            flags.append(patterns_of(raw, offsets))
        none = np.zeros(0, np.int64)
        return (np.concatenate([none, *rows]), np.concatenate([none, *found]),
                np.concatenate([none, *times]), np.concatenate([np.zeros((0, len(PATTERNS)), bool), *flags]))


def training_rows(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, text, label) of a bounded sample of the labelled rows that may be learned from.

    Rows of ``labels`` with a null are passed over; of several labels of a document the
    highest counts. The sample is bounded, so it is broadcast and the texts stay in place.
    """
    usable = usable_labels(labels, column)
    chosen = usable.where(_share(TRAIN_ROWS / max(usable.count(), 1)))
    return (docs.where(~held_out(HELD_OUT, FOLDS)).select("doc_id", "text")
            .join(F.broadcast(chosen), "doc_id").where("text is not null"))


def usable_labels(labels: DataFrame, column: str) -> DataFrame:
    return (labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
            .where(~held_out(HELD_OUT, FOLDS)).groupBy("doc_id").agg(F.max(column).alias("label")))


def _share(share: float):
    return F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(min(1.0, share) * 1_000_000)


def more_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, label) of a bounded sample of all rows that may be learned from, without labels."""
    free = docs.where(~held_out(HELD_OUT, FOLDS)).where("doc_id is not null")
    return (free.where(_share(MORE_ROWS / max(free.count(), 1))).where("text is not null")
            .select("doc_id", "text", F.lit(None).cast("int").alias("label")))


def telling_terms(train: DataFrame, n: int = TERMS) -> list[tuple[int, int]]:
    """(term, level): terms that hardly occur ``level`` times but in toxic texts, the best first."""
    names = [f"{what}_{k}" for k in range(1, LEVELS + 1) for what in ("toxic", "all")]

    def count(batches):
        hasher = SpanHasher()
        for batch in batches:
            label = batch.column("label").to_numpy().astype(np.int64)
            for first, raw, offsets in text_slices(batch.column("text")):
                term, row = terms_of(raw, offsets, hasher)
                if not len(term):
                    continue
                order = np.lexsort((row, term))
                term, row = term[order], row[order]
                edge = np.flatnonzero(np.concatenate(
                    [[True], (term[1:] != term[:-1]) | (row[1:] != row[:-1])]))
                times = np.diff(np.append(edge, len(term)))
                term, y = term[edge], label[first + row[edge]]
                edge = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
                sums = []
                for k in range(1, LEVELS + 1):
                    often = (times >= k).astype(np.int64)
                    sums += [np.add.reduceat(often * y, edge), np.add.reduceat(often, edge)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(term[edge].view(np.int64)), *map(pa.array, sums)], ["term", *names])

    schema = ", ".join(["term bigint", *(f"{c} bigint" for c in names)])
    counts = train.mapInArrow(count, schema).groupBy("term").agg(*(F.sum(c).alias(c) for c in names))
    # toxic texts held, less two for each other text held, at the best level
    best = F.greatest(*(F.struct(
        F.when((F.col(f"toxic_{k}") >= LEAST_DOCS)
               & ((F.col(f"toxic_{k}") + 0.5) / (F.col(f"all_{k}") + 1) >= LEAST_PRECISION),
               3 * F.col(f"toxic_{k}") - 2 * F.col(f"all_{k}")).otherwise(-1).alias("worth"),
        F.lit(k).alias("level")) for k in range(1, LEVELS + 1)))
    found = (counts.select("term", best.alias("best")).where("best.worth > 0")
             .orderBy(F.desc("best.worth"), "term").limit(n).collect())
    return [(r.term % (1 << 64), r.best.level) for r in found]


class LabelModel:
    """Accuracies and correlations of the voters, and the posterior of the class given their votes.

    A voter that abstains says nothing; a text on which all abstain is toxic with ``SILENT``, as
    no vote could tell. Voters are taken to be right more often than not: each begins
    with ``TRUST`` votes for each that it cast, ``RIGHT`` of them in toxic texts. Those that
    never meet others keep that, all others are judged by whom they agree with. Of the voters on a
    text each counts less by how far those beside it repeat it.
    """

    def __init__(self, n: int):
        self.prior = 0.05
        self.accuracy = np.full(n, RIGHT)
        self.rate = np.stack([np.full(n, 0.01), np.full(n, 0.2)])
        self.correlations = np.eye(n)
        self.swapped = False

    def logit(self, votes: np.ndarray) -> np.ndarray:
        odds = math.log(self.prior / (1 - self.prior))
        weight = np.log(self.accuracy / (1 - self.accuracy)) - odds
        out = odds + (votes * weight / np.maximum(votes @ self.correlations, 1.0)).sum(axis=1)
        return np.where(votes.any(axis=1), out, math.log(SILENT / (1 - SILENT)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        z = np.clip(self.logit(votes.astype(float)), -30, 30)
        return 1 / (1 + np.exp(z if self.swapped else -z))

    def sums(self, votes: np.ndarray, times: np.ndarray, moments: bool) -> np.ndarray:
        """What a pass over patterns adds to: votes and texts of each class; second moments of what the
        rates leave over."""
        votes = votes.astype(float)
        post = self.posterior(votes)
        one, zero = times * post, times * (1 - post)
        out = [one @ votes, zero @ votes, [one.sum(), zero.sum()]]
        if moments:
            gone = votes - (1 - post)[:, None] * self.rate[0] - post[:, None] * self.rate[1]
            out.append(((gone * times[:, None]).T @ gone).ravel())
        return np.concatenate(out)

    def update(self, sums: np.ndarray, moments: bool) -> float:
        """Take in a pass; returns how far the accuracies moved."""
        n = len(self.accuracy)
        one, zero, (texts_one, texts_zero) = sums[:n], sums[n:2 * n], sums[2 * n:2 * n + 2]
        if moments:  # by the rates that the pass was made with
            cov = sums[2 * n + 2:].reshape(n, n)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            self.correlations = np.clip(cov / sd / sd[:, None], 0, 1)
            np.fill_diagonal(self.correlations, 1.0)
        cast = one + zero
        accuracy = np.clip((one + TRUST * RIGHT * cast + 0.5) / ((1 + TRUST) * cast + 1), 1e-3, 1 - 1e-3)
        moved = float(np.abs(accuracy - self.accuracy).max(initial=0.0))
        self.accuracy = accuracy
        self.rate = np.clip(np.stack([(zero + 0.005) / (texts_zero + 0.5), (one + 0.05) / (texts_one + 0.5)]),
                            1e-5, 1 - 1e-5)
        self.prior = float(np.clip(texts_one / max(texts_one + texts_zero, 1e-9), 1e-4, 0.5))
        return moved


def fit_label_model(n: int, one_pass, rounds: int = 16) -> LabelModel:
    """Expectation maximisation; ``one_pass(model, moments)`` gives the sums over all patterns.

    Half-way the correlations are taken from what is left over once the class is known.
    """
    model = LabelModel(n)
    for k in range(rounds):
        moments = k == rounds // 2
        if model.update(one_pass(model, moments), moments) < 1e-4 and k > rounds // 2:
            break
    return model


def _unpacked(bits: list[bytes], n: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1)
    return np.unpackbits(rows, axis=1, count=n).astype(bool)


class Voters:
    """Terms that vote where they occur often enough, and some of the patterns."""

    def __init__(self, terms, level, patterns=range(len(PATTERNS))):
        self.terms, self.level, self.patterns = list(terms), np.asarray(level), list(patterns)

    def __len__(self):
        return len(self.terms) + len(self.patterns)

    def votes(self, finder: Finder, column) -> np.ndarray:
        rows, found, times, flags = finder.hits(column)
        out = np.zeros((len(column), len(self)), bool)
        often = times >= self.level[found] if len(found) else np.zeros(0, bool)
        out[rows[often], found[often]] = True
        out[:, len(self.terms):] = flags[:, self.patterns]
        return out


def vote_patterns(texts: DataFrame, voters: Voters) -> DataFrame:
    """(bits, n): how many texts each pattern of votes has, over all texts."""
    def count(batches):
        finder = Finder(voters.terms)
        for batch in batches:
            packed = np.packbits(voters.votes(finder, batch.column("text")), axis=1)
            bits, n = np.unique(packed, axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(n)], ["bits", "n"])

    return (texts.select("text").mapInArrow(count, "bits binary, n bigint")
            .groupBy("bits").agg(F.sum("n").alias("n")))


def passes(patterns: DataFrame, n: int):
    """``one_pass`` of ``fit_label_model`` over a table of patterns: a task sends its sums, nothing else."""
    def one_pass(model: LabelModel, moments: bool) -> np.ndarray:
        def part(batches):
            total = np.zeros(2 * n + 2 + (n * n if moments else 0))
            for batch in batches:
                if batch.num_rows:
                    votes = _unpacked(batch.column("bits").to_pylist(), n)
                    total += model.sums(votes, batch.column("n").to_numpy().astype(float), moments)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

        rows = patterns.mapInArrow(part, "sums array<double>").collect()
        return np.sum([r.sums for r in rows], axis=0) if rows else np.zeros(2 * n + 2 + (n * n if moments else 0))

    return one_pass


def fit_linear(x: np.ndarray, target: np.ndarray, penalty: float = 1.0, rounds: int = 25):
    """Weights (the last one a constant) of a logistic model for soft targets, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, x.T @ (target - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _features(rows: DataFrame, terms: list[int], extra: str):
    """(x, columns ``extra``) of a bounded table with ``text``: occurrences of the terms, then the patterns."""
    def read(batches):
        finder = Finder(terms)
        for batch in batches:
            found_in, found, times, flags = finder.hits(batch.column("text"))
            cut = np.searchsorted(found_in, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column(extra).cast(pa.float64()),
                 pa.array([found[a:b].tolist() for a, b in zip(cut, cut[1:])], pa.list_(pa.int32())),
                 pa.array([times[a:b].tolist() for a, b in zip(cut, cut[1:])], pa.list_(pa.int32())),
                 pa.array(flags.tolist(), pa.list_(pa.bool_()))], ["doc_id", extra, "hits", "times", "flags"])

    got = (rows.select("doc_id", "text", extra).mapInArrow(
        read, f"doc_id bigint, {extra} double, hits array<int>, times array<int>, flags array<boolean>")
        .orderBy("doc_id", extra, "hits").collect())
    x = np.zeros((len(got), len(terms) + len(PATTERNS)), np.float32)
    for i, r in enumerate(got):
        x[i, r.hits] = r.times
        x[i, len(terms):] = r.flags
    return x, np.array([r[extra] for r in got], float)


def choose_voters(labelled: DataFrame) -> Voters:
    """The telling terms that hardly ever are in a text labelled as clean, the lexicon, and the patterns; of the
    last two not those that the labels show to be wrong more often than right."""
    telling = telling_terms(labelled)
    lexicon = set(map(word_term, LEXICON))
    terms = [t for t, _ in telling] + sorted(lexicon - {t for t, _ in telling})
    level = np.array([k for _, k in telling] + [1] * (len(terms) - len(telling)))
    x, gold = _features(labelled, terms, "label")
    voted = x[:, :len(terms)] >= level
    def share(fired):
        return (gold[fired].sum() + 0.5) / (fired.sum() + 1)

    def right(fired):
        return fired.sum() < LEAST_DOCS or share(fired) >= 0.5

    least = VOTER_SHARE * gold.sum()
    sure = {i for i in range(len(telling)) if share(voted[:, i]) >= VOTER_PRECISION and voted[:, i].sum() >= least}
    chosen = sorted({*sure, *(i for i, t in enumerate(terms) if t in lexicon and right(voted[:, i]))})
    patterns = [k for k in range(len(PATTERNS)) if right(x[:, len(terms) + k] > 0)]
    return Voters([terms[i] for i in chosen], level[chosen], patterns)


def posteriors(rows: DataFrame, voters: Voters, model: LabelModel) -> DataFrame:
    """``rows`` (doc_id, text, label) with ``post``, the label model's posterior from the votes alone."""
    def add(batches):
        finder = Finder(voters.terms)
        for batch in batches:
            post = model.posterior(voters.votes(finder, batch.column("text")))
            yield batch.append_column("post", pa.array(post))

    return rows.mapInArrow(add, "doc_id bigint, text string, label int, post double")


def fit_toxicity(docs: DataFrame, labels: DataFrame):
    """(terms, weights) of the classifier; without a labelled text of both classes the lexicon and the patterns
    are the only voters, and without any vote it scores all alike."""
    labelled = staged(training_rows(docs, labels, "toxic").select("doc_id", "text", F.col("label").cast("int")),
                      "toxic_rows")
    voters = choose_voters(labelled)
    learned_from = docs.where(~held_out(HELD_OUT, FOLDS)).where("text is not null")
    patterns = staged(vote_patterns(learned_from, voters), "toxic_votes")
    model = fit_label_model(len(voters), passes(patterns, len(voters)))
    sample = staged(labelled.unionByName(more_rows(docs)), "toxic_sample")
    named = posteriors(sample.where("label is not null"), voters, model).groupBy("label").agg(
        F.avg("post").alias("post")).collect()
    mean = {r.label: r.post for r in named}
    model.swapped = len(mean) == 2 and mean[1] < mean[0]
    marked = staged(posteriors(sample, voters, model), "toxic_marked")
    as_label = F.when(F.col("post") >= 0.5, 1).otherwise(0).cast("int")
    found = [t for t, _ in telling_terms(marked.select("doc_id", "text", as_label.alias("label")))]
    terms = found + sorted(set(voters.terms) - set(found))
    x, target = _features(marked, terms, "post")
    discard(labelled, patterns, sample, marked)
    if not len(x):
        return terms, np.append(np.zeros(len(terms) + len(PATTERNS)), -3.0)
    return terms, fit_linear(x.astype(float), target)


def score_toxicity(docs: DataFrame, model) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``, from its text alone.

    Null and empty texts hold no term and get the score of the constant. Rows are
    independent, so repeated ones score alike; other columns are not read.
    """
    terms, weights = model
    small_batches(docs.sparkSession)

    def score(batches):
        finder = Finder(terms)
        for batch in batches:
            rows, found, times, flags = finder.hits(batch.column("text"))
            logit = np.full(batch.num_rows, weights[-1])
            np.add.at(logit, rows, weights[found] * times)
            if len(flags):
                logit += flags @ weights[len(terms):-1]
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p),
                 pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(HELD_OUT, FOLDS).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id bigint, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score_toxicity`` by the model that ``docs`` and ``labels`` (doc_id, toxic) give."""
    small_batches(docs.sparkSession)
    return score_toxicity(docs, fit_toxicity(docs, labels))


ship_by_value(__name__)
