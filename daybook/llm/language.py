"""Language identification with bit-sliced n-gram Bloom filters (operator 9).

Every slot of the filter holds one bit per language, so the AND of the k slots
of an n-gram is the mask of all languages that contain it: the languages in
whose training texts it stands, however often.  A text's masks are
counted per language, the counts are corrected for the filters' measured
false-positive rates, and the largest corrected count decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import arrow_map, fold, stored
from daybook.llm.sampling import hashed_fraction

NOT_LETTERS = re.compile(r"[\W\d_]+")
# Long n-grams tell languages apart even where all short ones stand in each; the short ones serve texts of a few letters.
SIZES = (1, 3, 6)
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def grams(text: str) -> np.ndarray | None:
    """64-bit codes of all letter n-grams (words padded by blanks); None without a letter."""
    clean = NOT_LETTERS.sub(" ", text.lower())
    if not any(map(str.isalpha, clean)):
        return None
    c = np.frombuffer(f" {clean.strip()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    out, code = [], c
    for n in range(1, max(SIZES) + 1):
        if n > 1:
            code = (code[:-1] * np.uint64(MIX[1])) ^ c[n - 1 :]
        if n in SIZES:
            out.append(code if n > 1 else code[code != 32])
    return np.concatenate(out)


@dataclass
class Filters:
    langs: list[str]
    slots: np.ndarray  # (m, words) of uint64
    wrong: np.ndarray  # false-positive rate by language

    def _masks(self, codes: np.ndarray) -> np.ndarray:
        shift = np.uint64(64 - int(self.slots.shape[0]).bit_length() + 1)
        mask = None
        for mix in MIX:
            at = ((codes ^ (codes >> np.uint64(29))) * np.uint64(mix)) >> shift
            mask = self.slots[at] if mask is None else mask & self.slots[at]
        return mask

    def counts(self, codes: np.ndarray) -> np.ndarray:
        """Corrected number of n-grams that each language contains."""
        masks = self._masks(codes)
        hits = np.empty(len(self.langs))
        for i in range(len(self.langs)):
            hits[i] = np.count_nonzero(masks[:, i // 64] & np.uint64(1 << (i % 64)))
        return np.maximum(0.0, (hits - self.wrong * len(codes)) / (1 - self.wrong))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = grams(text) if text and self.langs else None
        if codes is None:
            return "und", 0.0
        c = self.counts(codes)
        best = int(np.argmax(c))  # ties: the first by training size, then name
        total = float(c.sum())
        return self.langs[best], float(c[best]) / total if total > 0 else 0.0

    @classmethod
    def build(cls, langs: list[str], members: dict[str, np.ndarray]) -> Filters:
        most = max((len(x) for x in members.values()), default=1)
        m = 1 << max(10, int(np.ceil(np.log2(6 * max(1, most)))))
        self = cls(langs, np.zeros((m, -(-max(1, len(langs)) // 64)), np.uint64), np.zeros(len(langs)))
        shift = np.uint64(64 - int(m).bit_length() + 1)
        for i, lang in enumerate(langs):
            codes = members.get(lang, np.zeros(0, np.uint64))
            for mix in MIX:
                at = ((codes ^ (codes >> np.uint64(29))) * np.uint64(mix)) >> shift
                self.slots[at, i // 64] |= np.uint64(1 << (i % 64))
            filled = np.count_nonzero(self.slots[:, i // 64] & np.uint64(1 << (i % 64))) / m
            self.wrong[i] = min(0.99, filled ** len(MIX))
        return self


def _gram_counts(batch: pa.RecordBatch) -> dict | None:
    by_lang: dict[str, list[np.ndarray]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        codes = grams(text)
        if codes is not None:
            by_lang.setdefault(lang, []).append(codes)
    langs, codes, counts = [], [], []
    for lang, parts in by_lang.items():
        u, n = np.unique(np.concatenate(parts), return_counts=True)
        langs += [lang] * len(u)
        codes.append(u.astype(np.int64))
        counts.append(n)
    if not langs:
        return None
    return {"lang": langs, "code": np.concatenate(codes), "n": np.concatenate(counts).astype(np.int64)}


def train(rows: DataFrame, sample: int = 16_000) -> Filters:
    """Fit on (text, lang) rows; about ``sample`` of them at most, chosen by a hash of doc_id.

    Every n-gram of the chosen texts is in its language's filter.  The driver gets each of them
    once a language, so ``sample`` bounds what it holds.
    """
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = stored(
        arrow_map(hashed_fraction(rows, sample).select("lang", "text"), _gram_counts, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
    )
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total")).collect()
    langs = [r["lang"] for r in sorted(totals, key=lambda r: (-r["total"], r["lang"]))]
    held = counted.select("lang", "code").toArrow()
    owner = held.column("lang").combine_chunks().dictionary_encode()
    codes = held.column("code").to_numpy().view(np.uint64)
    at = owner.indices.to_numpy()
    return Filters.build(langs, {lang: codes[at == i] for i, lang in enumerate(owner.dictionary.to_pylist())})


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred, score for every row: ``und`` and 0 for null texts and texts without a letter."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def score(batch: pa.RecordBatch) -> dict:
        found = [shared.value.predict(t) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]}

    return arrow_map(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        score,
        "doc_id long, lang_pred string, score double",
    )


def identify_held_out(docs: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Learn from all folds but one and predict every row, with the fold flag."""
    part = fold(F.col("doc_id"), folds)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    filters = train(own.where(part != held_out))
    return identify(own, filters).select(
        "doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score"
    )
