"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document.

Every word and every character n-gram of it (with word borders) is hashed into a table of vectors. Of word
pairs one thing counts, whether a word repeats the one before it: such a place has a word of its own. A
document is the mean of its features' vectors, a linear layer and softmax give the two classes.
Vectors and layer are trained together by stochastic gradient descent in numpy, inside one task, on
a bounded sample of the labelled rows. Scoring needs one number per table row: the mean of vectors
times the layer's difference is the mean of their products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from coinslot.llm.rows import filled, slices, text_bytes

#: Labelled rows that training uses at most: those whose ids hash lowest.
MAX_TRAIN = 6000
BUCKETS = 1 << 16
DIM = 8
#: Passes over the sample, and steps at least: a small sample is passed more often.
EPOCHS, STEPS = 4, 6000
RATE = 0.5
#: Different words whose features are found together: bounds memory, changes no result.
WORD_BLOCK = 20_000
#: Lengths of character n-grams, in bytes.
NGRAMS = (3, 4, 5)

#: Stands for a repeated word; no text has it, as white space never is part of a word.
REPEAT = " again "

_M = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of every feature of every word one after another, and the word each belongs to."""
    border, end, nothing = (pa.scalar(x, pa.large_string()) for x in ("<", ">", ""))
    fenced = pc.binary_join_element_wise(border, words.cast(pa.large_string()), end, nothing)
    data, bounds = text_bytes(fenced)
    values = data.astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(words)), np.diff(bounds))
    found, owners = [], []
    for n in NGRAMS:
        if len(values) < n:
            continue
        span = len(values) - n + 1
        code = np.full(span, n, np.uint64)
        for k in range(n):
            code = code * np.uint64(0x100000001B3) + values[k : k + span]
        whole = owner[:span] == owner[n - 1 :]
        found.append(_mixed(code[whole]))
        owners.append(owner[:span][whole])
    # The word itself: its bytes weighted by place.
    place = np.arange(len(values)) - np.repeat(bounds[:-1], np.diff(bounds))
    weighted = _mixed(values * _M + place.astype(np.uint64))
    if len(words):
        found.append(_mixed(np.add.reduceat(weighted, bounds[:-1]) + _M))
        owners.append(np.arange(len(words)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)


def features_by_word(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of every feature, word by word, in the smallest type that holds them, and where each word's begin (with the end)."""
    found, counts = [np.empty(0, np.min_scalar_type(BUCKETS - 1))], [np.zeros(1, np.int64)]
    for at in range(0, len(words), WORD_BLOCK):
        block = words.slice(at, WORD_BLOCK)
        features, of_word = word_features(block)
        found.append(features[np.argsort(of_word, kind="stable")].astype(found[0].dtype))
        counts.append(np.bincount(of_word, minlength=len(block)))
    return np.concatenate(found), np.cumsum(np.concatenate(counts))


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words of some texts, the word at each place, and the text of each place, in text order.

    A place whose word repeats the one before it adds the word REPEAT.
    """
    split = pc.ascii_split_whitespace(filled(texts))
    coded = split.flatten().dictionary_encode()
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    at, owner = coded.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(texts)), lengths)
    again = np.flatnonzero((at[1:] == at[:-1]) & (owner[1:] == owner[:-1])) + 1
    words = pa.concat_arrays([coded.dictionary, pa.array([REPEAT], coded.dictionary.type)])
    return words, np.insert(at, again, len(words) - 1), np.insert(owner, again, owner[again])


def scores(texts: pa.Array, table: np.ndarray, bias: float) -> np.ndarray:
    """Probability of class 1 per text. ``table``: the folded number of each table row."""
    words, at, owner = _words(texts)
    features, of_word = word_features(words)
    total = np.bincount(of_word, table[features], len(words))
    count = np.bincount(of_word, minlength=len(words))
    sums = np.bincount(owner, total[at], len(texts))
    counts = np.bincount(owner, count[at], len(texts))
    return 1.0 / (1.0 + np.exp(-(sums / np.maximum(counts, 1) + bias)))


def train(texts: pa.Array, labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Trains on texts with labels 0 and 1; returns the folded table and bias. Without both classes: all 0.5."""
    table = np.zeros(BUCKETS, np.float64)
    if len(set(labels.tolist())) < 2:
        return table, 0.0
    words, at, owner = _words(texts)
    features, first = features_by_word(words)
    texts_first = np.searchsorted(owner, np.arange(len(texts) + 1))
    bags = []
    for k in range(len(texts)):
        seen, times = np.unique(at[texts_first[k] : texts_first[k + 1]], return_counts=True)
        parts = [features[first[w] : first[w + 1]] for w in seen]
        rows = np.concatenate(parts) if parts else features[:0]
        weights = np.repeat(times, [len(p) for p in parts]) if parts else np.empty(0)
        rows, inverse = np.unique(rows, return_inverse=True)
        weights = np.bincount(inverse, weights, len(rows))
        bags.append((rows, (weights / max(weights.sum(), 1)).astype(np.float32)))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    epochs = max(EPOCHS, -(-STEPS // len(bags)))
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for k in random.permutation(len(bags)):
            rows, weights = bags[k]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = weights @ vectors[rows]
            logits = mean @ layer + bias
            chance = np.exp(logits - logits.max())
            wrong = chance / chance.sum()
            wrong[labels[k]] -= 1
            vectors[rows] -= rate * len(rows) ** 0.5 * weights[:, None] * (layer @ wrong)
            layer -= rate * np.outer(mean, wrong)
            bias -= 0.1 * rate * wrong
    difference = layer[:, 1] - layer[:, 0]
    return (vectors @ difference).astype(np.float64), float(bias[1] - bias[0])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, text, label`` of at most ``limit`` labelled rows outside the held-out fold.

    Rows with a null id or a label other than 0 and 1 are not used; of an id labelled twice the greater
    label counts. The ids are chosen on the label table alone, so the texts are joined to a list whose
    size ``limit`` bounds.
    """
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    usable = given.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    once = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def held_out(doc_id):
    """The fold that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Trains in one task on ``text`` and ``label``; only the folded table (half a megabyte) reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("label", pa.int32())]))
        rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        texts = rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string())
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        table, bias = train(texts, rows.column("label").to_numpy().astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary()), pa.array([bias])], names=["model", "bias"])

    rows = sample.select("doc_id", "text", "label").repartition(1).mapInArrow(run, "model binary, bias double").collect()
    model = rows[0] if rows else None
    return (np.frombuffer(model[0], np.float64), model[1]) if model else (np.zeros(BUCKETS), 0.0)


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", into: str = "score") -> DataFrame:
    """The rows of ``docs`` with the probability of class 1 in the new column ``into``; null text counts as empty."""
    if into in docs.columns:
        raise ValueError(f"column {into} exists")
    names = [f"c{k}" for k in range(len(docs.columns))]
    at = names[docs.columns.index(text)]
    plain = docs.toDF(*names)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shipped.value
        for batch in batches:
            for part in slices(batch, at):
                score = scores(part.column(at), table, bias)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*names, "score"])

    schema = StructType([*plain.schema, StructField("score", DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*docs.columns, into)
