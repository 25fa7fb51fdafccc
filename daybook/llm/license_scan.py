"""License scan by conditional compression (operator 1).

A text is cut into blocks of neighbouring lines around its license cues, sized
to the templates and overlapping by half, so that every notice lies whole in one
of them.  Every block is compressed with each template as a zstandard raw
dictionary; the templates that shrink it are confirmed by the exact wording: the
words of the template that the block lacks and the words it has in between.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import license_texts
from daybook.llm.common import arrow_map

# Notices of public licenses; a parameter of the operator.  Headers, SPDX tags and full texts are in license_texts.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "BSD-3-Clause": "Released under the 3-Clause BSD License.",
    "CC0-1.0": "Licensed under CC0 1.0 Universal.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}
# A block is a candidate if it holds one of these, in any case.
CUES = re.compile(r"licen[cs]e|copyright|\bSPDX\b|\bCC[ -]?(?:BY|0)", re.I)
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
BLOCK_WORDS = 60  # longest span of a short notice; a block is twice as long
SPREAD = 1.5  # longest span of a longer notice, in words of its template
LEAST_MATCH = 0.8  # share of the template's words that must stand in the block, in order
UNBROKEN = 5  # a template of fewer words must stand word for word
ADDED = 1_000  # weight of a word between; a missing word weighs as much as ...
MISSING = (1_001, 3_000, 10_000)  # ... these, tried in turn


@cache
def _compressors(templates: tuple[tuple[str, str], ...]):
    def one(text: str | None):
        if text is None:
            return zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
        raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False, write_dict_id=False)

    return one(None), [one(text) for _, text in templates]


@cache
def _template_words(text: str) -> tuple[str, ...]:
    return tuple(w.lower() for w in WORD.findall(text))


@cache
def _by_span(templates: tuple[tuple[str, str], ...]) -> dict[int, list[tuple[int, tuple[str, ...], Counter]]]:
    """Longest span of a notice -> (number, words, word counts) of its templates."""
    out: dict[int, list] = {}
    for i, (_, text) in enumerate(templates):
        words = _template_words(text)
        span = BLOCK_WORDS
        while span < SPREAD * len(words):
            span *= 2
        if words:
            out.setdefault(span, []).append((i, words, Counter(words)))
    return out


def _windows(cues: list[int], n: int, span: int) -> list[tuple[int, int]]:
    """Word ranges of 2 * span words that hold every range of ``span`` words with a cue."""
    out = []
    a = b = -1
    for at in [*cues, None]:
        if at is not None and a >= 0 and at - span < b:
            b = min(n, at + span)
            continue
        if a >= 0:
            out += [(x, min(b, x + 2 * span)) for x in range(a, max(a + 1, b - span), span)]
        if at is not None:
            a, b = max(0, at - span), min(n, at + span)
    return out


class Words:
    """The words of a text, their places and lines, and the words with a cue."""

    def __init__(self, text: str):
        found = list(WORD.finditer(text))
        self.text = text
        self.words = [m.group().lower() for m in found]
        self.starts, self.ends = [m.start() for m in found], [m.end() for m in found]
        breaks = [m.start() for m in re.finditer("\n", text)]
        self.line = [bisect_right(breaks, s) for s in self.starts]
        self.cues = sorted({bisect_right(self.ends, m.start()) for m in CUES.finditer(text)})
        number: dict[str, int] = {}
        self.ids = np.array([number.setdefault(w, len(number)) for w in self.words], np.int64)
        self.number = number

    def block(self, a: int, b: int) -> str:
        """Text of the words from a to b, with what stands around them on their lines (not another word)."""
        start = self.ends[a - 1] if a else 0
        end = self.starts[b] if b < len(self.words) else len(self.text)
        start = max(start, self.text.rfind("\n", 0, self.starts[a]) + 1)
        stop = self.text.find("\n", self.ends[b - 1])
        return self.text[start : end if stop < 0 else min(end, stop)].strip()


def blocks(text: str | None) -> list[tuple[int, str]]:
    """(line number, block) of the candidate blocks for short notices."""
    w = Words(text or "")
    return [(w.line[a], w.block(a, b)) for a, b in _windows(w.cues, len(w.words), BLOCK_WORDS)]


def _align(want: np.ndarray, have: np.ndarray, weight: int) -> list[tuple[int, int]]:
    """Pairs of equal words of the alignment of ``want`` to a part of ``have`` with the least
    ``weight`` * words missing + ADDED * words between."""
    n, m = len(want), len(have)
    steps = np.arange(m + 1, dtype=np.int64) * ADDED
    moves = np.zeros((n, m + 1), np.uint8)  # 0 missing, 1 equal, 2 between
    row = np.zeros(m + 1, np.int64)
    for i in range(n):
        cur = row + weight
        equal = np.flatnonzero(have == want[i])
        equal = equal[row[equal] <= cur[equal + 1]]
        cur[equal + 1] = row[equal]
        moves[i, equal + 1] = 1
        row = np.minimum.accumulate(cur - steps) + steps
        moves[i, row < cur] = 2
    i, j, pairs = n, int(np.argmin(row)), []
    while i:
        move = moves[i - 1, j]
        if move == 2:
            j -= 1
            continue
        if move:
            j -= 1
            pairs.append((i - 1, j))
        i -= 1
    return pairs[::-1]


def _longest(want: np.ndarray, have: np.ndarray) -> list[tuple[int, int]]:
    """The alignment with the most words of ``want``, however many words stand between."""
    return _align(want, have, ADDED * (len(have) + 1))


def _enough(missing: int, total: int) -> bool:
    return missing <= (1 - LEAST_MATCH) * total + 1e-9


def _differences(pairs: list[tuple[int, int]], want, have) -> tuple[int, int, list[str]]:
    """(template words missing, words between, the differences) of an alignment."""
    said, added = [], 0
    edge = [(-1, None), *pairs, (len(want), None)]
    for (a, c), (b, d) in zip(edge, edge[1:]):
        if b > a + 1:
            said.append("-" + " ".join(want[a + 1 : b]))
        if c is not None and d is not None and d > c + 1:  # words around the notice are no difference
            added += d - c - 1
            said.append("+" + " ".join(have[c + 1 : d]))
    return len(want) - len(pairs), added, said


def _tags(w: Words, a: int, b: int, name: str) -> list[list[tuple[int, int]]]:
    """Places of an id in the SPDX license expressions of a block (ids joined by and, or, with)."""
    out = []
    for p in range(a, b):
        if w.words[p] != license_texts.TAG.lower():
            continue
        j = p + 1
        while j < b and w.line[j] == w.line[p]:
            if w.words[j] == name:
                out.append([(1, j)])
            j = j + 2 if j + 1 < b and w.words[j + 1] in ("and", "or", "with") else b
    return out


def _places(w: Words, a: int, b: int, want: tuple[str, ...], counts: Counter) -> list[list[tuple[int, int]]]:
    """Alignments (template word, word) of the confirmed notices of one template between words a and b."""
    n = len(want)
    if n == 2 and want[0] == license_texts.TAG.lower():
        return _tags(w, a, b, want[1])
    bag = Counter(w.words[a:b])
    if not _enough(n - sum(min(c, bag[x]) for x, c in counts.items()), n):
        return []
    if n < UNBROKEN:
        return [[(i, p + i) for i in range(n)] for p in range(a, b - n + 1) if tuple(w.words[p : p + n]) == want]
    ids = np.array([w.number.get(x, -1) for x in want], np.int64)
    if not _enough(n - len(_longest(ids, w.ids[a:b])), n):
        return []
    first = None
    for weight in MISSING:
        pairs = [(i, a + j) for i, j in _align(ids, w.ids[a:b], weight)]
        if pairs and _enough(n - len(pairs), n):
            break
        first = first or pairs
    else:
        pairs = first
        if not pairs:
            return []
        # a line may have any words between those of a notice
        lines = sorted({(w.line[c], c) for c in w.cues if a <= c < b}) if n < BLOCK_WORDS else []
        for line, c in lines:
            lo = max(a, c - BLOCK_WORDS // 2, bisect_right(w.line, line - 1))
            hi = min(b, c + BLOCK_WORDS // 2, bisect_right(w.line, line))
            wide = [(i, lo + j) for i, j in _longest(ids, w.ids[lo:hi])]
            if wide and _enough(n - len(wide), n):
                pairs = wide
                break
    own = [pairs] if _enough(n - len(pairs), n) else []
    left, right = pairs[0][1], pairs[-1][1] + 1
    return [*_places(w, a, left, want, counts), *own, *_places(w, right, b, want, counts)]


def scan_text(text: str | None, templates: tuple[tuple[str, str], ...]) -> list[tuple]:
    """(line, license, plain size, size with the template, missing, added, differences) of every
    confirmed notice.  Templates are ranked by how much they shrink the notice's lines, equal ones
    by their wording; of notices that overlap, the highest ranked whose wording confirms it counts."""
    if not text or not CUES.search(text):
        return []
    w = Words(text)
    plain, each = _compressors(templates)
    tag = license_texts.TAG.lower()
    found = []

    @cache
    def sizes(lo: int, hi: int, i: int | None) -> int:
        compressor = plain if i is None else each[i]
        return len(compressor.compress(w.block(lo, hi).encode("utf-8", "surrogatepass")))

    for span, own in _by_span(templates).items():
        for a, b in _windows(w.cues, len(w.words), span):
            raw = w.block(a, b).encode("utf-8", "surrogatepass")
            base = len(plain.compress(raw))
            tagged = tag in w.words[a:b]
            for i, want, counts in own:
                if want[0] == tag and not tagged:
                    continue
                size = len(each[i].compress(raw))
                if size >= base:
                    continue
                for pairs in _places(w, a, b, want, counts):
                    missing, added, said = _differences(pairs, want, w.words)
                    if want[0] == tag:
                        missing, said = 0, []
                    score = len(want) - 2 * missing - added
                    first, stop = pairs[0][1], pairs[-1][1] + 1
                    # the notice's own lines, longer ones cut around it
                    lo = max(bisect_right(w.line, w.line[first] - 1), first - BLOCK_WORDS // 2)
                    hi = min(bisect_right(w.line, w.line[stop - 1]), stop + BLOCK_WORDS // 2)
                    own_sizes = sizes(lo, hi, None), sizes(lo, hi, i)
                    less = own_sizes[0] - own_sizes[1]
                    found.append((-less, -score, templates[i][0], i, first, stop, own_sizes, missing, added, said))
    taken = np.zeros(len(w.words), bool)
    out = []
    for _, _, name, _, a, b, own_sizes, missing, added, said in sorted(found, key=lambda x: x[:6]):
        if taken[a:b].any():
            continue
        taken[a:b] = True
        out.append((w.line[a], a, name, *own_sizes, missing, added, "; ".join(said)))
    return [(x[0], *x[2:]) for x in sorted(out, key=lambda x: x[1])]


def wording(block: str, template: str) -> tuple[int, int, list[str]]:
    """(template words missing, words between, the differences) of the closest place in a block."""
    want, w = _template_words(template), Words(block)
    ids = np.array([w.number.get(x, -1) for x in want], np.int64)
    return _differences(_align(ids, w.ids, MISSING[0]), want, w.words)


def scan_block(block: str, templates: tuple[tuple[str, str], ...]) -> tuple | None:
    """(license, plain size, size with the template, missing, added, differences) of the closest notice, or None."""
    found = scan_text(block, templates)
    return min((x[1:] for x in found), key=lambda x: (x[3] + x[4], x[2], x[0])) if found else None


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per confirmed notice: doc_id, line, license, plain_bytes, template_bytes, missing, added, differences.

    ``line`` is the notice's first; ``template_bytes`` is the size of its lines
    given the template, ``missing`` and ``added`` count the differing words.
    ``templates`` takes the place of the notices, headers, SPDX tags and full
    texts known here.  Null and empty texts have no blocks; repeated rows give
    their rows each; null doc_ids are kept.
    """
    known = tuple(sorted(templates.items() if templates else [*TEMPLATES.items(), *license_texts.texts()]))

    def run(batch: pa.RecordBatch) -> dict | None:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            rows += [(doc_id, *hit) for hit in scan_text(text, known)]
        if not rows:
            return None
        cols = list(zip(*rows))
        names = ("doc_id", "line", "license", "plain_bytes", "template_bytes", "missing", "added", "differences")
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
        return {n: pa.array(c, k) for n, c, k in zip(names, cols, kinds)}

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(
        own.where(F.col("text").rlike("(?i)licen[cs]e|copyright|\\bSPDX\\b|\\bCC[ -]?(?:BY|0)")),
        run,
        "doc_id long, line int, license string, plain_bytes int, template_bytes int, missing int, added int, differences string",
    )
