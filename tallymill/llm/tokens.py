"""Token counts of whole texts under a byte-level BPE.

Huge texts are encoded in overlapping chunks with offsets. Two neighbours are spliced at a
boundary between pre-tokens that both have. It is stable if it lies far enough from the
right end of the left chunk: what the split pattern takes at a place depends only on the
run that begins there and the few characters behind it, never on what came before, so
from a shared boundary on both encodings are that of the whole text. Where an overlap has
no such boundary it is doubled, if need be up to the end of the text.

Texts made of plain Latin characters are counted with the rank-file twin of the
vocabulary, which gives the same tokens several times faster; all others, and all huge
ones, go through the library of the vocabulary itself.

Cases: null is the empty text, with no tokens. Strings of special tokens inside a text
count as that token, the library's default. Repeated rows are each counted; further
columns are ignored.
"""

from __future__ import annotations

import base64
import os
import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tallymill.llm.common import per_batch, texts

CHUNK, OVERLAP = 16_384, 512
#: Characters whose classes (letter, digit, space, other) are the same in every library.
PLAIN = re.compile(r"[\t\n\r -~¡-¬®-ȳ]*")


class Counter:
    """Counts with one vocabulary; ``ranks`` names its twin, if there is one."""

    def __init__(self, vocabulary: str, ranks: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True))) or r"(?!)")
        #: A pre-token is settled if so many characters follow it: a run's look-ahead and a whole special token.
        self.settled = 4 + max(map(len, specials), default=0)
        self.chunk, self.overlap = chunk, max(overlap, 2 * self.settled)
        self.twin = _twin(ranks) if ranks else None

    def count(self, text: str) -> int:
        if len(text) > 2 * self.chunk:
            return self.count_huge(text)
        if self.twin is not None and PLAIN.fullmatch(text):
            parts = self.special.split(text)
            return sum(len(self.twin.encode_ordinary(p)) for p in parts) + len(parts) - 1
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def _starts(self, text: str, begin: int, end: int) -> dict[int, int]:
        """Places where a pre-token begins in ``text[begin:end]``, with the tokens before each, and the end."""
        encoding = self.library.encode(text[begin:end], add_special_tokens=False)
        starts: dict[int, int] = {}
        last = None
        for n, (word, (a, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
            if word != last:
                starts[begin + a], last = n, word
        starts[end] = len(encoding.ids)
        return starts

    def count_huge(self, text: str) -> int:
        length, total, at, begin = len(text), 0, 0, 0
        end = min(length, self.chunk + self.overlap)
        left = self._starts(text, 0, end)
        while end < length:
            overlap = self.overlap
            while True:
                begin = max(at + 1, end - overlap)
                reach = min(length, begin + overlap + self.chunk)
                right = self._starts(text, begin, reach)
                last = end if end == length else end - self.settled
                common = [p for p in left if p in right and begin < p <= last]
                if common:
                    break
                # no stable boundary in the overlap: extend the left chunk as well and try a wider one
                overlap *= 2
                end = min(length, end + overlap)
                left = self._starts(text, at, end)
                if end == length:
                    return total + left[end] - left[at]
            splice = max(common)
            total += left[splice] - left[at]
            at, left, end = splice, right, reach
        return total + left[end] - left[at]


@cache
def _twin(ranks: str):
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@cache
def counter(vocabulary: str, ranks: str | None) -> Counter:
    return Counter(vocabulary, ranks)


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(docs: DataFrame, vocabulary: str, ranks: str | None = None, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs`` (doc_id, text). No shuffle."""

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(vocabulary, ranks)
        found = texts(batch)
        tokens = [own.count(t) for t in found]
        columns = [
            batch.column("doc_id"),
            pa.array([len(t.encode()) for t in found], pa.int64()),
            pa.array(tokens, pa.int64()),
            pa.array([n > limit for n in tokens], pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return per_batch(docs.select("doc_id", "text"), counted, SCHEMA)
