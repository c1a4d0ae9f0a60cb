"""Language-model scores from a hidden Markov model over words.

Tokens are the words of a text, A-Z lower-cased, and one end token. The model's symbols are the most
frequent words (at most `frequent`) and classes of rarer words (`classes`, by the word's last letters), so
the emission table has a fixed size, while word counts grow with the corpus:

    P(word | state) = P(symbol | state) * P(word | symbol)

P(word | symbol) is 1 for a frequent word; in a class it is (count + 1) / (tokens + words + 1), where the
1 stands for one unseen word. It does not depend on the state, so the likelihood of a text is the one
of its symbols by the scaled forward recursion, exact over the whole text, times these factors.

Training is Baum-Welch: in each step tasks run forward and backward over their texts, expected counts of
starts, moves and emissions are summed per task and by Spark across tasks, and the driver, which holds only
states x symbols numbers, makes the next parameters of them. All training texts take part. For training, texts are cut
into pieces of `piece` tokens; scores never are. Word counts and the probabilities of rare words
stay in DataFrames: rare words meet their counts in one join on the word.

Null and empty texts are one end token. A word's case beyond A-Z is kept. Rows are scored each on their own. Without any
training text all symbols are equally likely, and every word is unseen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.texts import LOWER_BYTES, crc_mod, slices
from tidegate.session import store

END = b"\n"  # no word holds it


def tokens_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split(), END]


def class_of(word: bytes, classes: int) -> int:
    """Rare words are classed by their last four bytes, which tell endings and languages apart."""
    return zlib.crc32(word[-4:]) % classes


@dataclass
class Model:
    start: np.ndarray  # states
    moves: np.ndarray  # states x states
    emits: np.ndarray  # symbols x states


def first_model(weights: np.ndarray, states: int, seed: int) -> Model:
    """States that keep to themselves, with emissions near the corpus's, each tilted at random."""
    rng = np.random.default_rng(seed)
    emits = (weights[:, None] + 1e-3) * rng.gamma(1.0, 1.0, (len(weights), states))
    moves = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * (0.9 - 0.1 / max(1, states - 1))
    return Model(np.full(states, 1 / states), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def batches_by_length(sequences: list[np.ndarray], width: int, cells: int = 1 << 21) -> Iterator[list[int]]:
    """Indices of `sequences`, longest first, in batches of `width`, or of fewer: padded to the longest, a batch has at most `cells` symbols."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    i = 0
    while i < len(order):
        n = max(1, min(width, cells // max(1, len(sequences[order[i]]))))
        yield order[i : i + n]
        i += n


def forward(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each sequence: states of many texts advance together, scaled at each step.

    Sequences are sorted by length, longest first, so those still running are the first ones.
    """
    lengths = np.array([len(s) for s in sequences])
    steps = np.zeros((int(lengths.max()), len(sequences)), np.int64)
    for i, s in enumerate(sequences):
        steps[: len(s), i] = s
    total = np.zeros(len(sequences))
    alpha = model.start * model.emits[steps[0]]
    active = len(sequences)
    for t in range(int(lengths[0])):
        if t:
            active = int(np.searchsorted(-lengths, -t, "left"))
            alpha = (alpha[:active] @ model.moves) * model.emits[steps[t, :active]]
        scale = alpha.sum(1)
        total[:active] += np.log(scale)
        alpha /= scale[:, None]
    return total


def expected_counts(model: Model, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch counts (starts, moves, emissions) of equally long `pieces` (time x pieces), and log-likelihood."""
    length, n = pieces.shape
    states = len(model.start)
    alphas, scales = np.empty((length, n, states)), np.empty((length, n))
    alpha = model.start * model.emits[pieces[0]]
    for t in range(length):
        if t:
            alpha = (alphas[t - 1] @ model.moves) * model.emits[pieces[t]]
        scales[t] = alpha.sum(1)
        alphas[t] = alpha / scales[t][:, None]
    moves = np.zeros((states, states))
    beta = np.ones((n, states))
    gammas = alphas  # overwritten from the end
    for t in range(length - 1, 0, -1):
        ahead = beta * model.emits[pieces[t]] / scales[t][:, None]
        moves += alphas[t - 1].T @ ahead
        gammas[t] *= beta
        beta = ahead @ model.moves.T
    gammas[0] *= beta
    flat = pieces.ravel()
    emits = np.stack([np.bincount(flat, gammas[..., k].ravel(), len(model.emits)) for k in range(states)], 1)
    return gammas[0].sum(0), moves * model.moves, emits, float(np.log(scales).sum())


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, count) over all tokens of `docs`. Tasks count in a table of bounded size before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "count"])
            counts.clear()
            return out

        for part in slices(batches, 0):
            for text in part.column(0).to_pylist():
                for w in tokens_of(text):
                    counts[w] = counts.get(w, 0) + 1
            if len(counts) > 500_000:
                yield flush()
        yield flush()

    counted = docs.select("text").mapInArrow(run, "word binary, count bigint")
    return counted.groupBy("word").agg(F.sum("count").alias("count"))


def encoded(docs: DataFrame, numbers: dict[bytes, int], classes: int) -> DataFrame:
    """Per row: row, doc_id, held_out, n_tokens, symbols (binary, 16 or 32 bits), and its rare words with their counts."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(numbers)
    base = len(numbers)
    kind = np.uint16 if base + classes < 1 << 16 else np.uint32
    held = docs.schema["held_out"].dataType.simpleString()
    ids = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        seen: dict[bytes, int] = {}
        for part in slices(batches, 2):
            symbols, words, counts, sizes = [], [], [], []
            for text in part.column(2).to_pylist():
                tokens = tokens_of(text)
                own = [get(w, -1) for w in tokens]
                rare: dict[bytes, int] = {}
                for i, s in enumerate(own):
                    if s < 0:
                        w = tokens[i]
                        rare[w] = rare.get(w, 0) + 1
                        tail = w[-4:]
                        c = seen.get(tail)
                        if c is None:
                            if len(seen) > 1_000_000:
                                seen.clear()
                            c = seen[tail] = base + class_of(w, classes)
                        own[i] = c
                symbols.append(np.array(own, kind).tobytes())
                words.append(list(rare))
                counts.append(list(rare.values()))
                sizes.append(len(tokens))
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(symbols, pa.binary()),
                pa.array(words, pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int32())),
            ], names=["doc_id", "held_out", "n_tokens", "symbols", "words", "counts"])

    made = docs.select("doc_id", "held_out", "text").mapInArrow(
        run, f"doc_id {ids}, held_out {held}, n_tokens bigint, symbols binary, words array<binary>, counts array<int>",
    )
    return store(made.withColumn("row", F.monotonically_increasing_id()), "encoded")


def baum_welch(texts: DataFrame, weights: np.ndarray, bits: int, states: int, steps: int, piece: int, seed: int, width: int = 256) -> Model:
    """Train on `texts` (symbols, of `bits` bits each), starting from symbol frequencies `weights`."""
    spark = texts.sparkSession
    model = first_model(weights, states, seed)
    kind = np.dtype(f"uint{bits}")
    size = len(weights)
    for _ in range(steps):
        current = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = current.value
            sums = [np.zeros(states), np.zeros((states, states)), np.zeros((size, states))]
            waiting: dict[int, list[np.ndarray]] = {}

            def count(pieces: list[np.ndarray]) -> None:
                for total, part in zip(sums, expected_counts(m, np.stack(pieces, 1).astype(np.int64))):
                    total += part

            for batch in batches:
                for raw in batch.column(0).to_pylist():
                    symbols = np.frombuffer(raw, kind)
                    for i in range(0, len(symbols), piece):
                        cut = symbols[i : i + piece]
                        # Pieces of one length advance together; what is shorter than a piece is cut by powers of two.
                        while len(cut):
                            n = piece if len(cut) == piece else 1 << (len(cut).bit_length() - 1)
                            same = waiting.setdefault(n, [])
                            same.append(cut[:n])
                            cut = cut[n:]
                            if len(same) == width * max(1, min(8, piece // n)):
                                count(same)
                                same.clear()
            for same in waiting.values():
                if same:
                    count(same)
            rows = [(-2, sums[0]), *((-3 - k, sums[1][k]) for k in range(states))]
            used = np.flatnonzero(sums[2].sum(1))
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in rows] + used.tolist(), pa.int32()),
                *[pa.array(np.concatenate(([v[k] for _, v in rows], sums[2][used, k])), pa.float64()) for k in range(states)],
            ], names=["symbol", *[f"s{k}" for k in range(states)]])

        columns = [f"s{k}" for k in range(states)]
        parts = texts.select("symbols").mapInArrow(run, "symbol int, " + ", ".join(f"{c} double" for c in columns))
        # One row per symbol and task at most goes into this sum, one per symbol comes out of it.
        summed = parts.groupBy("symbol").agg(*[F.sum(c).alias(c) for c in columns]).toPandas().set_index("symbol")
        emits = np.outer(weights + 1e-3, np.ones(states)) * 1e-3 / max(weights.sum(), 1)
        seen = summed.index[summed.index >= 0]
        emits[seen] += summed.loc[seen].to_numpy()
        moves = np.stack([summed.loc[-3 - k].to_numpy() if -3 - k in summed.index else np.zeros(states) for k in range(states)]) + 1e-2
        start = (summed.loc[-2].to_numpy() if -2 in summed.index else np.zeros(states)) + 1e-2
        model = Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
        current.unpersist()
    return model


def score_texts(
    docs: DataFrame, fold: int = 7, held: int = 2, frequent: int = 16_000, classes: int = 1_024,
    states: int = 6, steps: int = 3, piece: int = 256, seed: int = 11,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    split = docs.select("doc_id", (crc_mod(F.col("doc_id"), fold) == held).alias("held_out"), "text")
    counts = store(word_counts(split.filter("not held_out")), "word_counts")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.orderBy(F.col("count").desc(), "word").limit(frequent).collect()
    numbers = {bytes(r["word"]): k for k, r in enumerate(top)}
    # Counts of classes: the words beyond the most frequent ones.
    least = (top[-1]["count"], bytes(top[-1]["word"])) if top else (0, b"")
    rare = counts.filter((F.col("count") < least[0]) | ((F.col("count") == least[0]) & (F.col("word") > F.lit(bytearray(least[1])))))
    rare = rare.withColumn("class", F.crc32(F.substring("word", -4, 4)) % classes)
    by_class = {r["class"]: (r.n, r.v) for r in rare.groupBy("class").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    weights = np.array([r["count"] for r in top] + [by_class.get(k, (0, 0))[0] for k in range(classes)], float)
    texts = encoded(split, numbers, classes)
    bits = 16 if len(weights) < 1 << 16 else 32
    model = baum_welch(texts.filter("not held_out"), weights, bits, states, steps, piece, seed)

    # Rare words: the class's factor needs the word's count, wherever the word occurs.
    mass = [float(sum(by_class.get(k, (0, 0))) + 1) for k in range(classes)]
    used = texts.select("row", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.counts").alias("times"))
    masses = F.element_at(F.lit(mass), (F.crc32(F.substring("word", -4, 4)) % classes + 1).cast("int"))
    c = F.coalesce(F.col("count"), F.lit(0))
    met = used.join(rare.select("word", "count"), "word", "left")
    sums = met.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known"), F.sum(F.col("times") * F.log10(c + 1)).alias("ups"),
        F.sum(F.col("times") * F.log10(masses)).alias("downs"), F.sum("times").alias("rare"),
    )
    sums = sums.select(F.col("row").alias("of"), "known", "ups", "downs", "rare")
    logs = np.log10(np.array([r["count"] for r in top] + [0] * classes, float) + 1)
    shared = spark.sparkContext.broadcast((model, logs))
    kind = np.dtype(f"uint{bits}")
    ids = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, logs = shared.value
        for batch in slices(batches, 4, 2 << 20):
            sequences = [np.frombuffer(raw, kind).astype(np.int64) for raw in batch.column(4).to_pylist()]
            likelihood = np.zeros(len(sequences))
            for own in batches_by_length(sequences, 512):
                likelihood[own] = forward(model, [sequences[i] for i in own])
            base = [float(logs[s].sum()) for s in sequences]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(likelihood / np.log(10)), pa.array(base)], names=[*batch.schema.names[:4], "likelihood", "frequent_ups"],
            )

    scored = texts.select("row", "doc_id", "held_out", "n_tokens", "symbols").mapInArrow(
        run, f"row bigint, doc_id {ids}, held_out boolean, n_tokens bigint, likelihood double, frequent_ups double",
    )
    joined = scored.join(sums, F.col("row") == F.col("of"), "left")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    n, v = total.n, total.v
    down = float(np.log10(n + v + 1))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_tokens") - zero("rare") + zero("known")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("frequent_ups") + zero("ups") - F.col("n_tokens") * down).alias("base_score"),
        (F.col("likelihood") + zero("ups") - zero("downs")).alias("score"),
    )
