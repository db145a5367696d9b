"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs, drawn from its code point and a seed. A
run of three letters is bound into one vector by permuting and multiplying (roll(a, 2) * roll(b, 1)
* c), a text is the bundle (sum) of its runs' vectors, a language the bundle of its training texts
scaled to unit length. A text gets the language whose prototype has the greatest cosine with it.

Letters are those of any script, lowered; everything between them is one word edge, which is a
symbol of its own at either end of a run. Training bundles inside the tasks and sums one vector per
language and task; what reaches the driver is one vector per language. Prediction is a pass over
the rows without a shuffle. Whole texts are used, and all labelled rows that may be learned from.

Defined results: a null text, one without a letter, or any text when nothing was learned, is
``und`` with score 0. The score is the cosine, not below 0. Ties go to the first language in order.
Rows with a null text or language are not learned from. Repeated rows count as often as they come.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
SEED = 11
UNKNOWN = "und"
CACHE_ROWS = 1 << 15  # run vectors a worker keeps, one byte per dimension

_LOWER: list[np.ndarray] = []


def lower_letters() -> np.ndarray:
    """Per code point: its lower-case letter, or 0 where it is no letter."""
    if not _LOWER:
        table = np.zeros(0x110000, np.int64)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LOWER.append(table)
    return _LOWER[0]


def runs(text: str | None) -> np.ndarray:
    """The text's runs of three symbols, each as one number; none without a letter."""
    points = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    codes = np.concatenate(([0], lower_letters()[points], [0]))
    edge = codes == 0
    codes = codes[~(edge & np.concatenate(([False], edge[:-1])))]
    if len(codes) < 3:
        return np.empty(0, np.int64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    return ((a << 42) | (b << 21) | c)[b > 0]


class Space:
    """Run vectors, made when first asked for."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self._clear()

    def _clear(self) -> None:
        self.known = np.empty(0, np.int64)
        self.slots = np.empty(0, np.int64)
        self.vectors = np.empty((0, self.dimensions), np.int8)

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            rng = np.random.default_rng([self.seed, c])
            self.letters[c] = rng.integers(0, 2, self.dimensions, np.int8) * np.int8(2) - np.int8(1)
        return self.letters[c]

    def bind(self, run: int) -> np.ndarray:
        a, b, c = run >> 42, run >> 21 & 0x1FFFFF, run & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def bundle(self, found: np.ndarray) -> np.ndarray:
        """The sum of the vectors of all runs of a text."""
        out = np.zeros(self.dimensions, np.float32)
        unique, counts = np.unique(found, return_counts=True)
        for k in range(0, len(unique), CACHE_ROWS // 4):
            out += self._some(unique[k : k + CACHE_ROWS // 4], counts[k : k + CACHE_ROWS // 4])
        return out

    def _some(self, unique: np.ndarray, counts: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, unique)
        new = unique[self.known[np.minimum(at, len(self.known) - 1)] != unique] if len(self.known) else unique
        if len(new):
            if len(self.known) + len(new) > CACHE_ROWS:
                self._clear()
                new = unique
            fresh = np.stack([self.bind(int(r)) for r in new])
            self.slots = np.concatenate((self.slots, len(self.vectors) + np.arange(len(new))))
            self.vectors = np.concatenate((self.vectors, fresh))
            self.known = np.concatenate((self.known, new))
            order = np.argsort(self.known)
            self.known, self.slots = self.known[order], self.slots[order]
            at = np.searchsorted(self.known, unique)
        return counts.astype(np.float32) @ self.vectors[self.slots[at]].astype(np.float32)


def train(labelled: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, np.ndarray]:
    """A unit prototype for each language of ``labelled`` (text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(dimensions, seed), {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                vector = space.bundle(runs(text.as_py()))
                length = np.linalg.norm(vector)
                if length > 0:
                    sums[lang] = sums.get(lang, 0) + (vector / length).astype(np.float64)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions)), pa.array(vector)],
                names=["lang", "at", "x"],
            )

    usable = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    # Sums of decimals do not depend on the order of the tasks.
    total = F.sum(F.col("x").cast("decimal(30,9)")).cast("double").alias("x")
    rows = usable.mapInArrow(run, "lang string, at long, x double").groupBy("lang", "at").agg(total)
    out: dict[str, np.ndarray] = {}
    for lang, at, x in rows.collect():  # languages x dimensions
        out.setdefault(lang, np.zeros(dimensions))[at] = x
    return {k: v / max(np.linalg.norm(v), 1e-12) for k, v in sorted(out.items())}


def predict(
    docs: DataFrame,
    prototypes: dict[str, np.ndarray],
    carry: Sequence[str] = ("doc_id",),
    text: str = "text",
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> DataFrame:
    """``row`` (the columns carried), ``lang_pred`` and ``score``."""
    names = list(prototypes)
    matrix = np.array([prototypes[n] for n in names], np.float32).reshape(-1, dimensions)

    def one(space: Space, value: str | None) -> tuple[str, float]:
        found = runs(value)
        vector = space.bundle(found) if len(found) and names else None
        length = np.linalg.norm(vector) if vector is not None else 0
        if not length:
            return UNKNOWN, 0.0
        cosines = matrix @ vector / length
        best = int(np.argmax(cosines))
        return names[best], float(min(1.0, max(0.0, cosines[best])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(dimensions, seed)
        for batch in batches:
            out = [one(space, t.as_py()) for t in batch.column("lang_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([x[0] for x in out], pa.string()),
                 pa.array([x[1] for x in out], pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("lang_text")
    )
    schema = source.select(
        "row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")
    ).schema
    return source.mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether a document is kept from training; one without an id always is."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(True))
