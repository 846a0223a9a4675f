"""Toxicity by a counterfactually regularised classifier.

A logistic model over the words of a text, and how often words begin alike, is fitted so that
identity terms leave the score alone. Each labelled text that mentions a group gets two
counterfactual twins: one with each term swapped for the next of its kind and language, one with the
terms neutralised (left out). The loss adds ``fairness`` times the mean squared change of the
log-odds between a text and its twins. The swap alone would only give all groups the same
weight, which may be a large one where groups are mostly mentioned in toxic texts; the neutral
twin draws that weight to zero, so a neutral mention is judged by the words around it.

The fit sees at most ``most_labelled`` labelled texts, chosen by a hash of their ids; word counts
and the choice of words cover all of these. Only the fitted weights (at most ``most_words`` and
the identity terms) go to the executors. Every whole text is scored.

Cases: a null, empty or wordless text has the score that the intercept gives; ids that are
labelled twice count once, as toxic if either label is; a null label is no label; no labels at
all, or labels of one class, give a constant score; repeated rows are scored alike; a null id is
not held out; an empty table gives no rows; very long texts are read in pieces, whole; no other
column is read, whatever its name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

THRESHOLD = 0.3
SCORE = "__score"
MOST_LABELLED = 6000
MOST_WORDS = 512
#: Texts that must have a word, and the likelihood ratio that it must reach, to count as a feature.
LEAST_TEXTS = 5
LEAST_RATIO = 10.83
RIDGE = 1.0
#: Lengths of the word beginnings that count as features, and how often they must occur.
PREFIXES = (5, 7)
TIMES = (1, 2, 4)
FAIRNESS = 50.0
#: Bytes of texts, or of a piece of a longer one, that are cut into words at a time. A worker holds about
#: twenty times as much meanwhile.
CHUNK = 1 << 20

# Identity terms by kind and language. A term is swapped within its line.
IDENTITY = [
    "muslim christian jewish hindu buddhist sikh catholic protestant atheist",
    "muslims christians jews hindus buddhists sikhs catholics protestants atheists",
    "black white asian african european latino hispanic arab indian",
    "gay straight lesbian bisexual heterosexual homosexual transgender queer",
    "women men girls boys",
    "woman man girl boy",
    "immigrant refugee foreigner native",
    "immigrants refugees foreigners natives",
    "muslime christen juden hindus buddhisten katholiken protestanten atheisten",
    "frauen männer mädchen jungen",
    "ausländer flüchtlinge einwanderer migranten",
    "schwul lesbisch hetero bisexuell",
    "musulmans chrétiens juifs hindous bouddhistes catholiques athées",
    "femmes hommes filles garçons",
    "immigrés réfugiés étrangers migrants",
    "musulmanes cristianos judíos hindúes budistas católicos ateos",
    "mujeres hombres niñas niños",
    "inmigrantes refugiados extranjeros migrantes",
]

_SPACE = re.compile(rb"\s")


def lines_of() -> dict[str, list[list[str]]]:
    """Each identity term and the lines that have it (some are written alike in two languages)."""
    out: dict[str, list[list[str]]] = {}
    for line in IDENTITY:
        terms = line.split()
        for term in terms:
            out.setdefault(term, []).append(terms)
    return out


def swapped(found: set[str], lines: dict[str, list[list[str]]]) -> set[str]:
    """The words of a text with each identity term swapped for the next of its line; of several
    lines, the one that has most of the text's terms."""
    out = set()
    for w in found:
        if w in lines:
            line = max(lines[w], key=lambda terms: len(found.intersection(terms)))
            w = line[(line.index(w) + 1) % len(line)]
        out.add(w)
    return out


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of bounded size, cut at white space."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > CHUNK and (found := _SPACE.search(text, at + CHUNK)):
            end = found.start()
        yield text[at:end]
        at = end


def tokenised(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """The words (runs of letters, lower-cased) of whole texts, and the text that each is in."""
    pieces, owners = [], []
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            pieces.append(piece)
            owners.append(i)
    raw = pa.array(pieces, pa.large_binary())
    try:
        low = pc.utf8_lower(raw.cast(pa.large_string()))
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        low = pc.utf8_lower(pa.array([p.decode("utf-8", "replace") for p in pieces], pa.large_string()))
    owner, found = _split(np.array(owners, np.int64), low)
    # Most words stand between blanks; only the others need the pattern.
    plain = pc.utf8_is_alpha(found).to_numpy(zero_copy_only=False)
    rest = found.filter(pa.array(~plain))
    more, mixed = _split(owner[~plain], pc.replace_substring_regex(rest, r"[^\p{L}]+", " "))
    filled = pc.utf8_is_alpha(mixed).to_numpy(zero_copy_only=False)
    words = pa.concat_arrays([found.filter(pa.array(plain)), mixed.filter(pa.array(filled))])
    return np.concatenate([owner[plain], more[filled]]), words


def _split(owner: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    split = pc.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy()
    return np.repeat(owner, np.diff(bounds)), split.values.slice(bounds[0], bounds[-1] - bounds[0])


def prefixes(word: str) -> list[str]:
    return [word[:n] for n in PREFIXES if len(word) >= n]


def features(text: bytes) -> set[str]:
    """Words, and for each beginning of a word whether it occurs at least once, twice and four times."""
    counts = Counter(tokenised([text])[1].to_pylist())
    begins: Counter = Counter()
    for w, k in counts.items():
        for p in prefixes(w):
            begins[p] += k
    return set(counts) | {f"^{n}{p}" for p, k in begins.items() for n in TIMES if k >= n}


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(features(batch.column(0)[i].as_buffer().to_pybytes())) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.string()))], ["toxic", "words"])


class Model:
    """Weights of features and an intercept."""

    def __init__(self, weights: dict[str, float], intercept: float):
        self.weights, self.intercept = weights, intercept
        words = sorted(w for w in weights if w[0] != "^")
        begins = sorted({w[2:] for w in weights if w[0] == "^"})
        self.words, self.begins = pa.array(words, pa.large_string()), pa.array(begins, pa.large_string())
        self.word_weights = np.array([weights[w] for w in words])
        # What a beginning adds by how often it occurs, up to the highest count that matters.
        self.steps = np.array([[sum(weights.get(f"^{n}{p}", 0.0) for n in TIMES if n <= k) for k in range(max(TIMES) + 1)] for p in begins])

    @staticmethod
    def _counts(owner: np.ndarray, known: pa.Array, *columns: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature, count) of the known features among ``columns``, in this order."""
        hits = []
        for column in columns:
            at = pc.fill_null(pc.index_in(column, value_set=known), -1).to_numpy()
            hits.append(owner[at >= 0] * len(known) + at[at >= 0])
        pairs, counts = np.unique(np.concatenate(hits), return_counts=True)
        return pairs // max(1, len(known)), pairs % max(1, len(known)), counts

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """A score from 0 to 1 for each text; equal texts have equal scores."""
        owner, words = tokenised(texts)
        z = np.full(len(texts), self.intercept)
        if len(self.words):
            text, feature, _ = self._counts(owner, self.words, words)
            z += np.bincount(text, weights=self.word_weights[feature], minlength=len(texts))
        if len(self.begins):
            lengths = pc.utf8_length(words)
            cut = [pc.if_else(pc.greater_equal(lengths, k), pc.utf8_slice_codeunits(words, 0, k), None) for k in PREFIXES]
            text, feature, n = self._counts(owner, self.begins, *cut)
            z += np.bincount(text, weights=self.steps[feature, np.minimum(n, max(TIMES))], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))

    def score(self, text: bytes) -> float:
        return float(self.scores([text])[0])


def fit_weights(x: np.ndarray, twins: np.ndarray, y: np.ndarray, ridge: float, fairness: float, rounds: int = 25):
    """Newton's method for the penalised likelihood. ``twins`` holds, for each text that has one,
    its features minus those of its twin. Returns (weights, intercept)."""
    n, width = x.shape
    x = np.hstack([x, np.ones((n, 1))])
    penalty = np.diag(np.append(np.full(width, ridge), 1e-6))
    if len(twins):
        d = np.hstack([twins, np.zeros((len(twins), 1))])
        penalty = penalty + fairness * n * (d.T @ d) / len(twins)
    w = np.zeros(width + 1)
    rate = (y.sum() + 0.05) / (n + 1)
    w[-1] = math.log(rate / (1 - rate))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    most_labelled: int = MOST_LABELLED, most_words: int = MOST_WORDS, ridge: float = RIDGE, fairness: float = FAIRNESS,
) -> Model:
    """Fit on at most ``most_labelled`` of the labelled texts."""
    shared.ship(docs.sparkSession)
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.filter("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(most_labelled)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), shared.utf8(text_col).alias("text"))
    sample = texts.join(F.broadcast(known), "id").select("text", "toxic")  # bounded by most_labelled ids
    rows = shared.stored(sample.mapInArrow(_word_rows, "toxic int, words array<string>"), "labelled_words")
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    rate = (toxic + 0.05) / (n + 1)
    flat = Model({}, math.log(rate / (1 - rate)))
    if not 0 < toxic < n:
        shared.discard(rows)
        return flat

    def part(observed: F.Column, expected: F.Column) -> F.Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    a, total = F.col("a").cast("double"), F.col("total").cast("double")
    ratio = 2 * (
        part(a, total * toxic / n) + part(total - a, total * (n - toxic) / n)
        + part(toxic - a, (n - total) * toxic / n) + part(n - toxic - total + a, (n - total) * (n - toxic) / n)
    )
    counts = rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
    counts = counts.agg(F.sum("toxic").alias("a"), F.count("*").alias("total")).filter(F.col("total") >= LEAST_TEXTS)
    chosen = counts.withColumn("ratio", ratio).filter(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "word").limit(most_words)
    lines = lines_of()
    # A beginning of an identity term would carry what the term itself may not.
    hidden = {f"^{n}{p}" for w in lines for p in prefixes(w) for n in TIMES}
    names = sorted(({r.word for r in chosen.select("word").collect()} - hidden) | lines.keys())
    place = {w: i for i, w in enumerate(names)}
    kept = rows.select("toxic", F.array_intersect("words", F.array(*map(F.lit, names))).alias("words")).toLocalIterator()
    y, lists = [], []
    for r in kept:  # at most most_labelled short rows
        y.append(r.toxic)
        lists.append(r.words)
    shared.discard(rows)
    x = np.zeros((len(y), len(names)))
    twins = []
    for i, found in enumerate(lists):
        x[i, [place[w] for w in found]] = 1
        if lines.keys() & set(found):
            for other in (swapped(set(found), lines), set(found) - lines.keys()):
                twin = np.zeros(len(names))
                twin[[place[w] for w in other]] = 1
                twins.append(x[i] - twin)
    weights, intercept = fit_weights(x, np.array(twins).reshape(-1, len(names)), np.array(y, float), ridge, fairness)
    return Model({w: float(v) for w, v in zip(names, weights, strict=True) if abs(v) > 1e-9}, intercept)


def _scores(column: pa.Array, model: Model) -> np.ndarray:
    """The scores of texts, null as empty."""
    return model.scores([x.as_buffer().to_pybytes() if x.is_valid else b"" for x in column])


def _scorer(model: Model, text: int, width: int):
    """Column ``text`` has the texts; the first ``width`` columns are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.released(shared.slices(batches, text, CHUNK)):
            score = pa.array(_scores(batch.column(text), model), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], score], [*batch.schema.names[:width], SCORE])

    return run


def _filter(model: Model, threshold: float, text: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.released(shared.slices(batches, text, CHUNK)):
            kept = pa.array(_scores(batch.column(text), model) < threshold)
            yield pa.RecordBatch.from_arrays(batch.columns[:width], batch.schema.names[:width]).filter(kept)

    return run


def _quoted(name: str) -> F.Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _with_text(docs: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """``docs`` and the place of its text. A string column is sent to the workers once, as it is; any
    other text is added, last, as bytes under a name of its own."""
    names = [c.lower() for c in docs.columns]
    if text_col in docs.columns and names.count(text_col.lower()) == 1 and isinstance(docs.schema[text_col].dataType, T.StringType):
        return docs, docs.columns.index(text_col)
    name = "utf8"
    while name in names:
        name += "_"
    return docs.withColumn(name, shared.utf8(text_col)), len(names)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``__score``, from 0 to 1; an input column of that name is replaced."""
    shared.ship(docs.sparkSession)
    rows, text = _with_text(docs, text_col)
    kept = [k for k, c in enumerate(docs.columns) if c.lower() != SCORE]
    sent = kept if text in kept else [*kept, text]
    rows = rows.select(*(_quoted(rows.columns[k]) for k in sent))
    fields = [*rows.schema.fields[: len(kept)], T.StructField(SCORE, T.DoubleType())]
    return rows.mapInArrow(_scorer(model, sent.index(text), len(kept)), T.StructType(fields))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, columns of any name as they are."""
    shared.ship(docs.sparkSession)
    rows, text = _with_text(docs, text_col)
    return rows.mapInArrow(_filter(model, threshold, text, len(docs.columns)), docs.schema)


def held_out(column: str = "doc_id") -> F.Column:
    """Whether a row's label may not be learnt: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))
