"""Language ID by unigram piece models that sum over all segmentations.

The pieces are a fixed public vocabulary. Each language has a probability per
piece, learned by expectation maximisation over words; a word's probability is
the sum over all ways to cut it into pieces, found by the forward algorithm, and
a text's is the product over its words. A character outside the vocabulary is a
piece of its own kind.

The models are fitted on a bounded sample: at most ``FIT_DOCS`` documents, in hash
order, of each of the ``MOST_LANGS`` languages with the most documents, and all
their words, of any length: a word is all text without white space, a whole line in
some languages. Words longer than ``RUN`` are fitted in runs of that length.
Scoring reads whole texts and shuffles nothing; words are scored once per task
and looked up afterwards.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as
are all texts if no labelled text was given; equal rows get equal results; ties
go to the language first in code point order; words of any length are scored
whole; no rows give none. Columns are taken by the given names only.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from loreweave.llm.batches import slices
from loreweave.llm.text import held_out
from loreweave.operators.ranking import top_k

FIT_DOCS = 1_000
MOST_LANGS = 200
EM_ROUNDS = 3
#: Added to each piece's expected count.
PSEUDO = 0.05
#: Words kept per task; the store starts anew beyond it.
MOST_WORDS = 400_000
#: Longer words are fitted by logarithms, and scored one by one, with rescaling.
LONG_WORD = 48
#: Characters of long words that are fitted at once, and the longest run of them.
LONG_CELLS = 1 << 17
RUN = 1 << 12
#: Words of one length that are looked up at once.
WORDS = 4096
NONE = "und"

#: Finds all letters, and signs for numbers with them.
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text or ""))


def words_of(text: str) -> list[str]:
    """Lower-case words with the mark that pieces have at a word's start."""
    return ["▁" + w for w in text.lower().split()]


def load_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    return [sp.id_to_piece(i) for i in ids]


class Lattice:
    """Pieces of words by place: words of one length share an index array."""

    def __init__(self, pieces: list[str]) -> None:
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.absent, self.unknown = len(pieces), len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)

        by_length: dict[int, list[str]] = defaultdict(list)
        for piece in self.ids:
            by_length[len(piece)].append(piece)
        self.keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k, same in by_length.items():
            keys = list(self.hashes(same, k))[-1][:, -1]
            order = np.argsort(keys)
            self.keys[k] = keys[order], np.array([self.ids[x] for x in same], np.int32)[order]

    @staticmethod
    def hashes(words: list[str], longest: int) -> Iterator[np.ndarray]:
        """For each length up to ``longest``: 64-bit hashes of the substrings of words of equal length, by end."""
        n = len(words[0])
        codes = np.array(words, f"<U{n}").view("<u4").reshape(len(words), n).astype(np.uint64) + np.uint64(1)
        now = codes
        yield now
        for _ in range(1, min(n, longest)):
            now = now[:, :-1] * np.uint64(0x9E3779B97F4A7C15) + codes[:, -(now.shape[1] - 1) :]
            yield now

    def index(self, words: list[str]) -> np.ndarray:
        """``[word, end, length - 1]``: the piece of that length that ends there."""
        n, size = len(words[0]), min(len(words[0]), self.longest)
        out = np.full((len(words), n, size), self.absent, np.int32)
        out[:, :, 0] = self.unknown
        for k, found in enumerate(self.hashes(words, size), 1):
            if k in self.keys:
                keys, ids = self.keys[k]
                at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                here = out[:, k - 1 :, k - 1]
                np.copyto(here, ids[at], where=keys[at] == found)
        return out


def forward(index: np.ndarray, p: np.ndarray) -> np.ndarray:
    """``[word, end]`` sums over all segmentations up to each end; ``p`` is by piece, absent ones 0."""
    n, size = index.shape[1:]
    alpha = np.zeros((len(index), n + 1, *p.shape[1:]))
    alpha[:, 0] = 1
    for end in range(1, n + 1):
        for k in range(1, min(end, size) + 1):
            alpha[:, end] += alpha[:, end - k] * p[index[:, end - 1, k - 1]]
    return alpha


def fit(words: list[str], counts: np.ndarray, pieces: list[str]) -> np.ndarray:
    """Log probabilities of the pieces and of the unknown character (last) for one language."""
    lattice = Lattice(pieces)
    runs = [w[i : i + RUN] for w in words for i in range(0, len(w), RUN)]
    counts = np.repeat(np.asarray(counts, float), [-(-len(w) // RUN) for w in words])
    groups: dict[int, list[int]] = defaultdict(list)
    long: list[int] = []
    for i, w in enumerate(runs):
        (groups[len(w)] if len(w) <= LONG_WORD else long).append(i)
    some = [at[i : i + WORDS] for at in groups.values() for i in range(0, len(at), WORDS)]
    total = len(pieces) + 2
    p = np.full(total, 1.0 / total)
    p[lattice.absent] = 0
    for _ in range(EM_ROUNDS):
        expected = np.full(total, PSEUDO)
        for part in some:
            index = lattice.index([runs[i] for i in part])
            front, back = forward(index, p), _backward(index, p)
            weight = counts[part] / front[:, -1]
            length, size = index.shape[1:]
            for end in range(1, length + 1):
                for k in range(1, min(end, size) + 1):
                    at = index[:, end - 1, k - 1]
                    share = front[:, end - k] * p[at] * back[:, end] * weight
                    expected += np.bincount(at, share, total)
        for at in _long_batches(runs, long):
            expected += _expected_long(lattice, [runs[i] for i in at], counts[at], p)
        expected[lattice.absent] = 0
        p = expected / expected.sum()
    return np.log(np.delete(p, lattice.absent))


def _backward(index: np.ndarray, p: np.ndarray) -> np.ndarray:
    n, size = index.shape[1:]
    beta = np.zeros((len(index), n + 1))
    beta[:, n] = 1
    for start in range(n - 1, -1, -1):
        for k in range(1, min(n - start, size) + 1):
            beta[:, start] += p[index[:, start + k - 1, k - 1]] * beta[:, start + k]
    return beta


def _long_batches(words: list[str], at: list[int]) -> Iterator[list[int]]:
    """Words of like length, the longest first, of about ``LONG_CELLS`` characters together."""
    at = sorted(at, key=lambda i: -len(words[i]))
    while at:
        n = max(1, LONG_CELLS // len(words[at[0]]))
        yield at[:n]
        at = at[n:]


def _expected_long(lattice: Lattice, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Expected counts of the pieces over long words, the longest first, by logarithms of the sums."""
    index = lattice.index(words)
    length, size = index.shape[1:]
    ends, rows = np.array([len(w) for w in words]), np.arange(len(words))
    front, back = np.zeros((len(words), length + 1)), np.full((len(words), length + 1), -np.inf)
    for end in range(1, length + 1):
        k = np.arange(1, min(end, size) + 1)
        near = front[:, end - 1]
        sums = (np.exp(front[:, end - k] - near[:, None]) * p[index[:, end - 1, k - 1]]).sum(axis=1)
        front[:, end] = near + np.log(sums)
    back[rows, ends] = 0
    for start in range(length - 1, -1, -1):
        n = int(np.searchsorted(-ends, -start))  # words that go on behind start
        k = np.arange(1, min(length - start, size) + 1)
        near = back[:n, start + 1]
        sums = (np.exp(back[:n, start + k] - near[:, None]) * p[index[:n, start + k - 1, k - 1]]).sum(axis=1)
        back[:n, start] = near + np.log(sums)
    expected, whole = np.zeros(len(p)), front[rows, ends]
    for k in range(1, size + 1):
        at = index[:, k - 1 :, k - 1]
        share = np.exp(front[:, : length + 1 - k] + back[:, k:] - whole[:, None]) * p[at] * counts[:, None]
        expected += np.bincount(at.ravel(), share.ravel(), len(p))
    return expected


@dataclass
class Models:
    """What a task needs: about 32,000 numbers per language."""

    langs: list[str]
    pieces: list[str]
    log_p: np.ndarray  # [piece and unknown, language]
    log_prior: np.ndarray


class Scorer:
    """Log likelihoods of texts under all languages, by a store of words."""

    def __init__(self, models: Models) -> None:
        self.lattice = Lattice(models.pieces)
        self.p = np.exp(np.insert(models.log_p, self.lattice.absent, -np.inf, axis=0))
        self.prior = models.log_prior
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(models.langs)))

    def learn(self, words: set[str]) -> None:
        new = list(words.difference(self.known))
        if len(self.known) + len(new) > MOST_WORDS:
            self.known, self.table, new = {}, self.table[:0], list(words)
        groups: dict[int, list[str]] = defaultdict(list)
        rows = [self.table]
        for w in new:
            groups[min(len(w), LONG_WORD + 1)].append(w)
        for length, same in groups.items():
            if length > LONG_WORD:
                rows.append(np.array([self.long_word(w) for w in same]))
            else:
                for at in range(0, len(same), WORDS):
                    rows.append(np.log(forward(self.lattice.index(same[at : at + WORDS]), self.p)[:, -1]))
            start = len(self.known)
            self.known.update(zip(same, range(start, start + len(same)), strict=True))
        self.table = np.concatenate(rows)

    def long_word(self, word: str) -> np.ndarray:
        """The forward algorithm over a window of ends, rescaled at each step."""
        get, longest = self.lattice.ids.get, self.lattice.longest
        window, scale = [np.ones(self.p.shape[1])], np.zeros(self.p.shape[1])
        for end in range(1, len(word) + 1):
            here = window[-1] * self.p[get(word[end - 1], self.lattice.unknown)]
            for k in range(2, len(window) + 1):
                at = get(word[end - k : end])
                if at is not None:
                    here = here + window[-k] * self.p[at]
            scale += np.log(here)
            window = [w / here for w in window[1 - longest :]] + [np.ones_like(here)] if longest > 1 else [np.ones_like(here)]
        return scale

    def __call__(self, texts: list[str | None]) -> tuple[list[int], list[float]]:
        """The best language of each text, -1 for none, and its posterior probability."""
        none = not self.table.shape[1]
        texts = [None if none or not has_letter(t) else words_of(t) for t in texts]
        self.learn({w for words in texts if words for w in words})
        best, score = [], []
        for words in texts:
            if words is None:
                best.append(-1)
                score.append(0.0)
                continue
            total = self.table[list(map(self.known.__getitem__, words))].sum(axis=0) + self.prior
            i = int(total.argmax())
            best.append(i)
            score.append(float(1 / np.exp(total - total[i]).sum()))
        return best, score


def fit_models(labelled: DataFrame, text_col: str, lang_col: str, order: Column, pieces: list[str]) -> Models:
    """Models of all languages in ``lang_col``; rows without text or language are left out."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), order.alias("place"))
    rows = rows.filter("text is not null and lang is not null")
    known = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("least"))
    known = known.orderBy(F.desc("n"), "lang").limit(MOST_LANGS).collect()
    shares = {r["lang"]: r["n"] for r in known}
    # A share of each language that holds about twice the documents needed, and its
    # first one in any case, goes into the exact choice.
    asked = [(r["lang"], int(min(1.0, 2 * FIT_DOCS / r["n"]) * 1_000_000), r["least"]) for r in known]
    asked = F.broadcast(rows.sparkSession.createDataFrame(asked, "of string, share long, least long"))
    near = (F.pmod("place", F.lit(1_000_000)) <= F.col("share")) | (F.col("place") == F.col("least"))
    some = rows.join(asked, (F.col("lang") == F.col("of")) & near).drop("of", "share", "least")
    sample = top_k(some, ["lang"], FIT_DOCS, F.col("place"), F.col("text")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[tuple[str, str]] = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.update((lang, w) for w in words_of(text))
            langs, words = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(found.values(), pa.int64())],
                ["lang", "word", "n"],
            )

    counted = sample.mapInArrow(count, "lang string, word string, n bigint")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def learn(part: pa.Table) -> pa.Table:
        part = part.sort_by("word")
        log_p = fit(part["word"].to_pylist(), part["n"].to_numpy(), pieces)
        return pa.table({"lang": part["lang"].slice(0, 1), "log_p": pa.array([log_p.tolist()])})

    learned = counted.groupBy("lang").applyInArrow(learn, "lang string, log_p array<double>").collect()
    learned = sorted(learned, key=lambda r: r["lang"].encode())
    langs = [r["lang"] for r in learned]
    total = sum(shares[x] for x in langs)
    return Models(
        langs, pieces,
        np.array([r["log_p"] for r in learned]).T.reshape(len(pieces) + 1, len(langs)),
        np.log(np.array([shares[x] / total for x in langs])),
    )


def predict(docs: DataFrame, text_col: str, models: Models) -> DataFrame:
    """``row, lang_pred, score``; ``row`` is the input row."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    rows, place = docs.select(F.struct("*").alias("row")), docs.columns.index(text_col)
    out = StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        scorer = Scorer(models)
        names = [*models.langs, NONE]
        for batch in batches:
            at = 0
            for texts in slices(pc.struct_field(batch.column(0), place)):
                best, score = scorer(texts)
                rows = batch.column(0).slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array([names[i] for i in best], pa.string()), pa.array(score, pa.float64())],
                    ["row", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, out)


def identify(docs: DataFrame, id_col: str, text_col: str, lang_col: str, vocabulary: str) -> DataFrame:
    """``row, held_out, lang_pred, score``; rows with a remainder of 2 teach nothing. ``row`` has id and text."""
    out = held_out(F.col(id_col), 4, 2)
    pieces = load_pieces(vocabulary)
    models = fit_models(docs.filter(~out), text_col, lang_col, F.xxhash64(F.col(id_col).cast("string")), pieces)
    found = predict(docs.select(id_col, text_col), text_col, models)
    return found.select("row", held_out(F.col(f"row.{id_col}"), 4, 2).alias("held_out"), "lang_pred", "score")
