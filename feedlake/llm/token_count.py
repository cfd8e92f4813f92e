"""Token counts with overlap resynchronisation (operator 7).

A text longer than ``huge`` characters is encoded in overlapping chunks with
offsets, and neighbouring chunks are spliced at a common boundary that is
proven stable: both encodings start a token there, right after an ASCII white
space.  The tokenizer drops white space, composes no character across it, and
has no token that holds it, so what stands left of such a place can't change
the tokens right of it, nor the other way round.  If an overlap has none, it
is widened; if it reaches back to the chunk's start, the chunk is widened.

The same stability lets shorter texts be counted piece by piece: the pieces
between white spaces repeat heavily, so each is encoded by the library once
per worker (in a bounded cache).

Defined results: null and empty texts have no tokens; every row gives a row.
Special strings inside texts are treated as the library does by default, as
single tokens; they hold no white space.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

import numpy as np
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import annotate

MODEL = "word_bpe_49k.json"
HUGE, CHUNK, OVERLAP = 32_768, 16_384, 256
LIMIT = 2048
CACHE_PIECES = 500_000
CACHE_BYTES = 64
BLANKS = " \t\n\x0b\x0c\r"


@functools.cache
def tokenizer(path: str) -> tokenizers.Tokenizer:
    """The tokenizer of a file; a bare name is a file of ``public_tokenizers``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    if not os.path.dirname(path):
        import public_tokenizers

        path = public_tokenizers.path(path)
    model = tokenizers.Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return model


class Counter:
    """Counts tokens as ``model`` gives them for a whole text."""

    def __init__(self, model: tokenizers.Tokenizer, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.model, self.huge, self.chunk, self.overlap = model, huge, chunk, overlap
        self.cache: dict[bytes, int] = {}
        self.widened = 0

    def _starts(self, text: str, a: int, b: int) -> np.ndarray:
        """Places in ``text`` where the tokens of its part [a, b) start."""
        offsets = self.model.encode(text[a:b], add_special_tokens=False).offsets
        return a + np.array([o[0] for o in offsets], dtype=np.int64)

    @staticmethod
    def _stable(text: str, left: np.ndarray, right: np.ndarray, after: int) -> int | None:
        """The first proven stable boundary common to both encodings."""
        for place in np.intersect1d(left, right).tolist():
            if place > after and text[place - 1] in BLANKS:
                return place
        return None

    def count_huge(self, text: str) -> int:
        """Tokens of a text that is encoded in overlapping chunks."""
        n, total, begin = len(text), 0, 0
        end = min(n, self.chunk)
        left = self._starts(text, 0, end)
        while end < n:
            overlap, place = self.overlap, None
            while place is None and (start := end - overlap) > begin:
                stop = min(n, end + self.chunk - self.overlap)
                right = self._starts(text, start, stop)
                place = self._stable(text, left, right, start)
                if place is None:
                    self.widened += 1
                    overlap *= 2
            if place is None:  # no boundary in the whole chunk: widen the chunk
                end = min(n, begin + 2 * (end - begin))
                left = self._starts(text, begin, end)
                continue
            total += int(np.searchsorted(left, place))
            left, begin, end = right[np.searchsorted(right, place) :], place, stop
        return total + len(left)

    def count(self, texts: list[str]) -> list[int]:
        pieces = [t.encode().split() if len(t) <= self.huge else [] for t in texts]
        wanted = set().union(*pieces)
        known = {p: n for p in wanted if (n := self.cache.get(p)) is not None}
        new = [p for p in wanted if p not in known]
        for lo in range(0, len(new), 4096):
            part = new[lo : lo + 4096]
            coded = self.model.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            known.update((p, len(e)) for p, e in zip(part, coded, strict=True))
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache = {p: n for p, n in known.items() if len(p) <= CACHE_BYTES}
        else:
            self.cache.update((p, known[p]) for p in new if len(p) <= CACHE_BYTES)
        return [
            self.count_huge(t) if len(t) > self.huge else sum([known[p] for p in ps])
            for t, ps in zip(texts, pieces, strict=True)
        ]


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, limit: int = LIMIT,
    huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """Per document: id, UTF-8 bytes, tokens, and whether they exceed ``limit``."""

    def make() -> Callable[[list[str]], list]:
        counter = Counter(tokenizer(model), huge, chunk, overlap)
        return lambda texts: [counter.count(texts)]

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = annotate(
        narrow.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")), "text", "n_tokens long", make
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
