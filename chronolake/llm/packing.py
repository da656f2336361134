"""Best-fit packing of token sequences in bulk-synchronous steps.

Documents are tokenized, cut if they are longer than a sequence, and range-sorted by length; each piece
gets its rank among those of its length. Pieces of one length are interchangeable, and so are gaps of one
size, so the state of the packing is a table of runs: intervals of ranks, and intervals of sequences with the
same gap. It has at most CAPACITY sizes however many documents there are.

The steps go from long to short. In one step all pieces of a length are matched: a sweep over the gap sizes
finds their successor, the smallest gap that holds them, then the next one; which piece gets which gap is
settled by rank. The matched gaps shrink, the rest open sequences, and the next step follows. That is
exactly best fit in decreasing order. At the end every task places its pieces by searching its rank among
the runs of its length.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.llm.ranks import numbered
from chronolake.llm.text import text_of
from chronolake.session import stored

CAPACITY = 2048  # tokens of a sequence
END = 0  # id behind each document
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"  # the same vocabulary for the faster of the two libraries
BLANKS = 10_000  # the faster library runs out of stack on runs of several hundred thousand blanks

# One row for each run of ranks: ``per`` pieces of this length in each of the sequences from ``sequence`` on.
RUN = ["length", "rank", "pieces", "per", "sequence", "offset"]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_files() -> tuple[str, str, str]:
    """Tokenizer file, rank file, and the pattern that cuts texts before both."""
    import public_tokenizers

    return vocabulary_path(), vocabulary_path(RANKS), public_tokenizers.PATTERN


class Encoder:
    """Ids of the tokenizer file, with the strings of special tokens as ordinary text.

    Texts of printable Latin characters go through the rank file: the same ids at a quarter of the time.
    For all others the two libraries' character classes might differ, so the tokenizer file is used, and for
    texts with very long runs of blanks, too.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.vocabulary, self.exact = vocabulary, None
        self.other = re.compile("[^\t\n\r\x20-\x7e\xa1-\u024f]")
        self.blanks = re.compile("\\s+")

    def ids(self, text: str) -> list[int]:
        if not self.other.search(text) and not self._long_blanks(text):
            return self.fast.encode_ordinary(text)
        if self.exact is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task for each core
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.vocabulary)
            self.exact.encode_special_tokens = True
        return self.exact.encode(text, add_special_tokens=False).ids

    def _long_blanks(self, text: str) -> bool:
        return len(text) > BLANKS and any(m.end() - m.start() > BLANKS for m in self.blanks.finditer(text))


def _cut(files: tuple[str, str, str], capacity: int, end: int):
    """Pieces of each text with the checksum of their ids; of a cut text, the first piece takes the rest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(*files)
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch["key"].tolist(), batch["text"]):
                ids = np.array([*encoder.ids(text), end], dtype="<u4")
                start, piece = 0, 0
                while start < len(ids):
                    stop = start + ((len(ids) - start - 1) % capacity + 1 if start == 0 else capacity)
                    part = ids[start:stop]
                    rows.append((key, piece, start, len(part), zlib.crc32(part.tobytes())))
                    start, piece = stop, piece + 1
            yield pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids_crc32"])

    return run


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """The runs of RUN for so many pieces of each length."""
    runs: list[tuple[int, ...]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, sequences)
    opened = 0
    for length in sorted(counts, reverse=True):
        rank, left = 1, counts[length]
        shrunk: list[tuple[int, int, int]] = []

        def fill(gap: int, first: int, count: int) -> tuple[int, int, int]:
            """Match pieces to ``count`` sequences of one gap; what's left of both, and the next rank."""
            nonlocal rank, left
            per = gap // length
            full = min(count, left // per)
            if full:
                runs.append((length, rank, full * per, per, first, capacity - gap))
                shrunk.append((gap - per * length, first, full))
                rank, left = rank + full * per, left - full * per
            if full < count and left:  # the last few pieces share one more sequence
                runs.append((length, rank, left, left, first + full, capacity - gap))
                shrunk.append((gap - left * length, first + full, 1))
                rank, left, full = rank + left, 0, full + 1
            return gap, first + full, count - full

        for gap in sorted(g for g in gaps if g >= length):
            rest = []
            for first, count in gaps[gap]:
                _, after, remaining = fill(gap, first, count) if left else (gap, first, count)
                if remaining:
                    rest.append((after, remaining))
            gaps[gap] = rest
            if not rest:
                del gaps[gap]
            if not left:
                break
        if left:
            fresh = -(-left // (capacity // length))
            fill(capacity, opened, fresh)
            opened += fresh
        for gap, first, count in shrunk:
            if gap:
                gaps[gap].append((first, count))
    return runs


def _placed(runs: list[tuple[int, ...]]):
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, len(RUN))
    lengths, ranks = table[:, 0], table[:, 1]

    def run(batches):
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            # Runs are sorted by (length, rank): search the lengths first, then the ranks within each.
            at = np.zeros(len(batch), dtype=np.int64)
            for value in np.unique(length):
                low, high = np.searchsorted(lengths, [value, value + 1])
                own = length == value
                at[own] = low + np.searchsorted(ranks[low:high], rank[own], side="right") - 1
            _, first, _, per, sequence, offset = table[at].T
            nth = rank - first
            yield batch.drop(columns="rank").assign(
                sequence_id=sequence + nth // per, offset=offset + nth % per * length
            )

    return run


def pack(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = CAPACITY,
    end: int = END,
    files: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Pack all documents, as token ids and the id ``end``, into sequences of at most ``capacity`` tokens.

    Returns one row for each piece: ``key``, ``piece`` (int, from 0), ``start`` (ids of the document before
    it), ``length``, ``ids_crc32`` (of the ids as unsigned little-endian 32-bit numbers), ``sequence_id``
    (from 0, without gaps) and ``offset`` (place in the sequence; the pieces of a sequence are gapless).

    Null and empty texts are the id ``end`` alone. Only documents longer than a sequence are cut. Pieces of
    the same length are ranked by id, then piece, ids that are null first; repeated rows are packed
    one by one. An empty table gives an empty result, other columns are ignored whatever their names.
    ``files`` are those of ``tokenizer_files``, which every executor must be able to read.
    """
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(f"`{key}`").alias("key"), text_of(F.col(f"`{text}`")).alias("text"))
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = stored(texts.mapInPandas(_cut(files or tokenizer_files(), capacity, end), schema), "pieces")
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    runs = best_fit({r["length"]: r["n"] for r in counts}, capacity)
    if not runs:
        return pieces.selectExpr(f"key AS `{key}`", "piece", "start", "length", "ids_crc32", "0L AS sequence_id", "0L AS offset")
    ranked = numbered(pieces, "length", "key", "piece")
    placed = ranked.mapInPandas(_placed(runs), schema + ", sequence_id long, offset long")
    return placed.withColumnRenamed("key", key)
