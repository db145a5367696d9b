"""Quality by a convolutional network over bytes.

Every byte has a small learned vector; learned filters of ``WIDTH`` bytes move over the whole text
in steps of ``STRIDE`` and are cut at zero. Two neighbouring blocks of ``BLOCK`` bytes are a chunk,
so chunks overlap by half and cover the text. A chunk keeps the maximum of each filter and maps the
maxima to hidden units, which therefore also see what a chunk lacks. The text keeps the maximum and
the mean of each hidden unit over its chunks, and one logistic unit makes a probability of them.

The fit is bounded and the scoring is not. It takes at most ``TRAIN_ROWS`` labelled rows of each
class, those with the least hash of their id, of at most ``TRAIN_BYTES`` bytes each, and trains in
numpy on the driver with Adam and a fixed seed. Classes weigh alike in the fit; afterwards the bias
is moved to the shares they have among all labelled rows, which are counted in Spark. The fitted
network, some kilobytes, travels with the tasks; scoring is one pass over the rows without a
shuffle, and every byte of every text takes part.

Defined results: a null text is scored as an empty one, which is one chunk of padding; where one of
the classes has no labelled row, every score is the share of class 1 (1 without any label). Rows
with a null label or id are not learned from; a label other than 1 counts as 0. Repeated rows and
labels count as often as they come. An empty table gives no rows.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.llm.rows import order_key

EMBED, WIDTH, STRIDE = 8, 8, 2
FILTERS, HIDDEN = 24, 16
BLOCK = 64
SEED = 43
TRAIN_ROWS = 1200  # of each class
TRAIN_BYTES = 1 << 16  # of a text that is learned from
EPOCHS, BATCH, RATE = 10, 32, 0.01
SLAB = 1 << 11  # blocks whose filters are worked out at a time
PAD = 256  # the symbol after a text's last byte

STEPS = BLOCK // STRIDE


@dataclass
class Laid:
    """Texts as symbols, each from the start of a block on and with padding at its end."""

    symbols: np.ndarray
    first: np.ndarray  # block at which a text starts, and one more for the end

    @staticmethod
    def of(texts: Sequence[bytes]) -> "Laid":
        sizes = np.array([(len(t) + WIDTH + BLOCK - 1) // BLOCK for t in texts], np.int64)
        first = np.concatenate(([0], np.cumsum(sizes)))
        symbols = np.full(int(first[-1]) * BLOCK + WIDTH, PAD, np.int16)
        for text, at in zip(texts, (first[:-1] * BLOCK).tolist()):
            symbols[at : at + len(text)] = np.frombuffer(text, np.uint8)
        return Laid(symbols, first)


def _windows(symbols: np.ndarray) -> np.ndarray:
    """The symbols under the filters, a row for each step."""
    return np.lib.stride_tricks.sliding_window_view(symbols, WIDTH)[: len(symbols) - WIDTH : STRIDE]


class Network:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.w = {
            "embed": rng.normal(0, 0.5, (PAD + 1, EMBED)),
            "filters": rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)),
            "filter_bias": np.zeros(FILTERS),
            "hidden": rng.normal(0, 1 / np.sqrt(FILTERS), (FILTERS, HIDDEN)),
            "hidden_bias": np.zeros(HIDDEN),
            "out": rng.normal(0, 0.1, 2 * HIDDEN),
            "out_bias": np.zeros(1),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.constant: float | None = None  # the score of all texts, if nothing could be learned

    def _blocks(self, laid: Laid, where: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """The maximum of each filter in each block and, if asked, the step that has it."""
        n = int(laid.first[-1])
        top = np.empty((n, FILTERS), np.float32)
        at = np.empty((n, FILTERS), np.int64) if where else None
        last = np.zeros(n, bool)
        last[laid.first[1:] - 1] = True
        for k in range(0, n, SLAB):
            m = min(SLAB, n - k)
            part = laid.symbols[k * BLOCK : (k + m) * BLOCK + WIDTH]
            seen = self.w["embed"][part].reshape(-1)
            # A row holds the vectors of WIDTH neighbours; the next row starts STRIDE of them on.
            rows = np.lib.stride_tricks.as_strided(
                seen, (m * STEPS, WIDTH * EMBED), (4 * EMBED * STRIDE, 4), writeable=False
            )
            value = (rows @ self.w["filters"]).reshape(m, STEPS, FILTERS)
            # From here on a filter would look into the next text; all that it leaves out is padding.
            value[last[k : k + m], STEPS - WIDTH // STRIDE + 1 :] = -np.inf
            top[k : k + m] = value.max(1)
            if where:
                at[k : k + m] = value.argmax(1) + (np.arange(k, k + m) * STEPS)[:, None]
        return np.maximum(top + self.w["filter_bias"], 0), at

    @staticmethod
    def _chunks(laid: Laid) -> np.ndarray:
        """For each block the second block of its chunk: the next one, if it is of the same text."""
        other = np.arange(1, int(laid.first[-1]) + 1)
        other[laid.first[1:] - 1] -= 1
        return other

    def _chunk_units(self, top: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pooled = np.maximum(top, top[other])
        return pooled, np.maximum(pooled @ self.w["hidden"] + self.w["hidden_bias"], 0)

    def logits(self, texts: Sequence[bytes]) -> np.ndarray:
        laid = Laid.of(texts)
        _, units = self._chunk_units(self._blocks(laid, False)[0], self._chunks(laid))
        starts, sizes = laid.first[:-1], np.diff(laid.first)[:, None]
        # Sums in double precision: a text's score must not depend on its neighbours in the batch.
        mean = np.add.reduceat(units.astype(np.float64), starts, axis=0) / sizes
        both = np.concatenate([np.maximum.reduceat(units, starts, axis=0), mean], axis=1)
        return both @ self.w["out"].astype(np.float64) + float(self.w["out_bias"][0])

    def scores(self, texts: Sequence[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -60, 60)))

    def gradients(self, texts: Sequence[bytes], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean log loss. A maximum passes its gradient to the one place that has it."""
        laid, w = Laid.of(texts), self.w
        top, at = self._blocks(laid, True)
        other = self._chunks(laid)
        pooled, units = self._chunk_units(top, other)
        starts, sizes = laid.first[:-1], np.diff(laid.first)
        text_of = np.repeat(np.arange(len(texts)), sizes)
        high = np.maximum.reduceat(units, starts, axis=0)
        mean = np.add.reduceat(units, starts, axis=0) / sizes[:, None]
        both = np.concatenate([high, mean], axis=1)
        score = 1 / (1 + np.exp(-np.clip(both @ w["out"] + w["out_bias"][0], -60, 60)))
        d = (weights * (score - labels) / weights.sum()).astype(np.float32)

        g = {"out": d @ both, "out_bias": np.array([d.sum()])}
        d_both = d[:, None] * w["out"]
        best = units == high[text_of]
        ties = np.add.reduceat(best.astype(np.float32), starts, axis=0)
        d_units = best * (d_both[:, :HIDDEN] / ties)[text_of] + (d_both[:, HIDDEN:] / sizes[:, None])[text_of]
        d_units *= units > 0
        g["hidden"], g["hidden_bias"] = pooled.T @ d_units, d_units.sum(0)
        d_pooled = d_units @ w["hidden"].T
        second = top[other] > top
        d_top = np.where(second, 0, d_pooled)
        np.add.at(d_top, other, np.where(second, d_pooled, 0))
        d_top *= top > 0
        g["filter_bias"] = d_top.sum(0)
        # How much each filter's gradient has on each symbol at each of its places.
        block, unit = np.nonzero(d_top)
        seen = _windows(laid.symbols)[at[block, unit]].astype(np.int64)
        cell = (unit[:, None] * WIDTH + np.arange(WIDTH)) * (PAD + 1) + seen
        held = np.bincount(
            cell.reshape(-1), np.repeat(d_top[block, unit], WIDTH), FILTERS * WIDTH * (PAD + 1)
        ).reshape(FILTERS, WIDTH, PAD + 1).astype(np.float32)
        shaped = w["filters"].reshape(WIDTH, EMBED, FILTERS)
        g["filters"] = np.einsum("fks,se->kef", held, w["embed"], optimize=True).reshape(WIDTH * EMBED, FILTERS)
        g["embed"] = np.einsum("fks,kef->se", held, shaped, optimize=True)
        return g

    def fit(self, texts: Sequence[bytes], labels: np.ndarray, seed: int = SEED) -> None:
        rng = np.random.default_rng([seed, 1])
        weights = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step, total = 0, EPOCHS * -(-len(texts) // BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(texts))
            for k in range(0, len(order), BATCH):
                some = order[k : k + BATCH]
                g = self.gradients([texts[i] for i in some], labels[some], weights[some])
                step += 1
                rate = RATE * (1 - (step - 1) / total)
                for name, x in g.items():
                    first[name] += 0.1 * (x - first[name])
                    second[name] += 0.001 * (x * x - second[name])
                    m, v = first[name] / (1 - 0.9**step), second[name] / (1 - 0.999**step)
                    self.w[name] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "quality",
    rows: int = TRAIN_ROWS,
    most_bytes: int = TRAIN_BYTES,
    seed: int = SEED,
) -> Network:
    """The network for ``label`` (1 or not) of ``labels`` (doc_id and labels), learned from documents
    (doc_id, text) whose id is ``usable``, a condition on ``doc_id``."""
    one = F.col(label) == 1
    known = labels.select("doc_id", one.cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL").filter(usable)
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    network = Network(seed)
    if len(counts) < 2:
        network.constant = float(min(counts, default=1))
        return network
    # Ids first, and texts of the chosen ids only: both bounded by ``rows``.
    picked = [
        r for y in (0, 1)
        for r in known.filter(F.col("y") == y).orderBy(order_key(seed, F.col("doc_id")), "doc_id").limit(rows).collect()
    ]
    chosen = docs.sparkSession.createDataFrame(picked, known.schema)
    texts = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .filter(F.octet_length("text") <= most_bytes)
        .join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")
    )
    found = sorted((str(r["doc_id"]), r["y"], r["text"].encode()) for r in texts.collect())
    y = np.array([r[1] for r in found], np.float32)
    if len(set(y.tolist())) < 2:
        network.constant = counts[1] / sum(counts.values())
        return network
    network.fit([r[2] for r in found], y, seed)
    network.w["out_bias"] += np.float32(np.log(counts[1] / counts[0]))
    return network


def score(docs: DataFrame, network: Network, carry: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``row`` (the columns carried) and ``score``, the probability of label 1."""
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("cnn_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                texts = [t.as_py() or b"" for t in pc.cast(batch.column("cnn_text"), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(network.scores(texts), pa.float64())], names=["row", "score"]
                )

    return source.mapInArrow(run, source.select("row", F.lit(0.0).alias("score")).schema)
