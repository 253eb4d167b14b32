"""Vector bin packing of tokenised documents into training sequences.

Every document becomes token ids followed by a separator.  Ids are cut into items;
a sequence has three capacities at once: tokens, segments (pieces) and loss-bearing
tokens.  Whole runs that fill a sequence alone are placed directly; the remaining
ends are packed by the dot-product heuristic: the open sequence takes the item whose
demand vector has the largest dot product with the capacity that is left.  When no
item fits whole, one is cut to the room that is left and its rest goes back to the
pool, so padding arises only at the end of a partition or at the segment limit.

Each input partition is packed on its own, in a stream with a bounded pool: there is
no shuffle, no group and no driver state, and a lost task is simply run again.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from airshed.llm.memory import give_back, given_back

SEPARATOR = 0
#: Byte-level pre-tokenizers never join across a space between two characters that are
#: not white space, so the parts are encoded one by one and remembered.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Latin letters, ASCII digits and signs: in a text of these alone the pre-tokens of the
#: byte-level pattern can be told apart by a simple expression.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = re.compile(rf"[{LATIN}0-9 \n!-&(-/:-@\[-`{{-~]*")
PRE_TOKEN = re.compile(rf" ?[{LATIN}]+| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+")
#: A space and letters: as many as ``LINE`` new words of this kind are encoded in one text,
#: in which every one is a pre-token.
SPACED = re.compile(rf" [{LATIN}]+")
LINE = 256
#: Such texts encoded together.
LINES = 32
REMEMBERED = 600_000
#: Characters encoded together.
TOGETHER = 2_000_000
POOL = 512
SMALLEST_CUT = 8


@dataclass(frozen=True)
class Limits:
    """Capacities of one sequence."""

    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


class _Numbers(dict):
    """Numbers of words in order of their first use; ``new`` has those without ids yet, whose
    numbers follow ``known``."""

    def __init__(self):
        self.new: list[str] = []
        self.known = 0

    def __missing__(self, word: str) -> int:
        value = self[word] = self.known + len(self.new)
        self.new.append(word)
        return value


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes, with a bounded memory of words.

    A word of a text costs one look-up of its number; ids are then gathered for many texts
    together from one array that has the ids of all remembered words.
    """

    def __init__(self, path: str | None):
        # Spark runs a worker per core; threads of the library would only compete.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Other kinds of tokenizers get whole texts.
        self.by_parts = "ByteLevel" in repr(self.tokenizer.pre_tokenizer)
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.ends = np.zeros(1, dtype=np.int64)  # of each word's ids; the first entry is 0
        self.ids = np.zeros(0, dtype="<u4")
        self.used = 0

    def _parts(self, text: str) -> list[str]:
        if not self.by_parts or any(s in text for s in self.special):
            return [text]
        if PLAIN.fullmatch(text):
            return PRE_TOKEN.findall(text)
        parts = CUT.split(text)
        parts[1:] = [f" {p}" for p in parts[1:]]
        return parts

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and the number of ids of each."""
        spaced = np.array([bool(self.by_parts and SPACED.fullmatch(w)) for w in words])
        many = [w for w, s in zip(words, spaced) if s]
        alone = [w for w, s in zip(words, spaced) if not s]
        size = np.zeros(len(words), dtype=np.int64)
        ids, sizes = [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype=np.int64)]
        # A few lines at a time: full encodings are much larger than their ids.
        for i in range(0, len(many), LINE * LINES):
            part = ["".join(many[j:j + LINE]) for j in range(i, min(i + LINE * LINES, len(many)), LINE)]
            for x in self.tokenizer.encode_batch(part, add_special_tokens=False):  # the fast form names no words
                ids.append(np.array(x.ids, dtype="<u4"))
                sizes.append(np.bincount(x.word_ids))
        size[spaced] = np.concatenate(sizes)
        sizes = []
        for i in range(0, len(alone), LINE * LINES):
            for x in self.tokenizer.encode_batch_fast(alone[i:i + LINE * LINES], add_special_tokens=False):
                ids.append(np.array(x.ids, dtype="<u4"))
                sizes.append(len(ids[-1]))
        size[~spaced] = sizes
        flat = np.concatenate(ids)
        # The ids stand in order of lines, then of words alone.
        order = np.append(np.flatnonzero(spaced), np.flatnonzero(~spaced))
        start = np.empty(len(words), dtype=np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        end = np.cumsum(size)
        return flat[np.repeat(start - end + size, size) + np.arange(len(flat))], size

    def _learn(self) -> None:
        """Ids of the words that are new; the arrays grow by half, so words are copied rarely."""
        numbers, new = self.numbers, self.numbers.new
        if not new:
            return
        ids, size = self._encode(new)
        known, used = numbers.known + len(new), self.used + len(ids)
        if known >= len(self.ends):
            self.ends = np.append(self.ends, np.zeros(known + known // 2, dtype=np.int64))
        if used > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(used + used // 2, dtype="<u4"))
        self.ends[numbers.known + 1:known + 1] = self.used + np.cumsum(size)
        self.ids[self.used:used] = ids
        for word in [w for w in new if len(w) > 100]:
            del numbers[word]  # its number is not used again
        numbers.known, numbers.new, self.used = known, [], used

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.numbers.known > REMEMBERED or self.used > 8 * REMEMBERED:
            self.forget()
        parts = [self._parts(t) for t in texts]
        count = np.fromiter(map(len, parts), np.int64, len(parts))
        word = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(parts)), np.int64, int(count.sum()))
        self._learn()
        start, size = self.ends[word], self.ends[word + 1] - self.ends[word]
        end = np.cumsum(size)
        ids = self.ids[np.repeat(start - end + size, size) + np.arange(int(size.sum()))]
        cut = np.append(0, end)[np.append(0, np.cumsum(count))]
        return [ids[a:b].tobytes() for a, b in zip(cut, cut[1:])]


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Item:
    """Ids ``start`` to ``end`` of a document; ids from ``free`` to the separator bear loss."""

    __slots__ = ("document", "ids", "free", "total", "start", "end")

    def __init__(self, document, ids: bytes, free: int, start: int, end: int):
        self.document, self.ids, self.free = document, ids, free
        self.total, self.start, self.end = len(ids) // 4, start, end

    def loss(self, end: int) -> int:
        return max(0, min(end, self.total - 1) - max(self.start, self.free))

    def fitting(self, room: int, room_loss: int) -> int:
        """The end of the longest first part within both limits."""
        end = min(self.end, self.start + room)
        return end if self.loss(end) <= room_loss else max(self.start, self.free) + room_loss


class Packer:
    """Packs the items of one partition; ``out`` gathers rows of placed pieces."""

    def __init__(self, limits: Limits, partition: int):
        self.limits = limits
        self.next = partition << 36
        self.items: list[Item] = []
        self.out: list[tuple] = []

    def place(self, item: Item, end: int, sequence: int, offset: int) -> None:
        start = item.start
        ids = item.ids[4 * start:4 * end]
        self.out.append((item.document, start, end - start, zlib.crc32(ids), item.total, sequence,
                         offset, item.loss(end), ids))
        item.start = end

    def add(self, document, ids: bytes, free: int = 0) -> None:
        """Cut off runs that fill a sequence; the end joins the pool.  ``free``: how many
        ids at the front bear no loss."""
        limits, total, start = self.limits, len(ids) // 4, 0
        while start < total:
            item = Item(document, ids, free, start, total)
            start = item.fitting(limits.tokens, limits.loss)
            if start - item.start == limits.tokens:
                self.place(item, start, self.next, 0)
                self.next += 1
            else:
                item.end = start
                self.items.append(item)
        if len(self.items) >= 2 * POOL:
            self.pack(POOL)

    def pack(self, leave: int = 0) -> None:
        """Fill sequences from the pool until at most ``leave`` items are left."""
        limits, items = self.limits, self.items
        size = np.array([i.end - i.start for i in items], dtype=np.float64)
        loss = np.array([i.loss(i.end) for i in items], dtype=np.float64)
        there = np.ones(len(items), dtype=bool)
        left = len(items)
        while left > leave:
            room, room_loss, segments, offset = limits.tokens, limits.loss, limits.segments, 0
            while room and segments and left:
                fits = there & (size <= room) & (loss <= room_loss)
                if fits.any():
                    score = (size * (room / limits.tokens**2) + segments / limits.segments**2
                             + loss * (room_loss / limits.loss**2))
                    k = int(np.argmax(np.where(fits, score, -1.0)))
                    end, there[k] = items[k].end, False
                    left -= 1
                else:
                    # Nothing fits whole: cut the longest item to the room.
                    k = int(np.argmax(np.where(there, size, -1.0)))
                    end = items[k].fitting(room, room_loss)
                    if end - items[k].start < (SMALLEST_CUT if offset else 1):
                        break
                item = items[k]
                n, used = end - item.start, item.loss(end)
                self.place(item, end, self.next, offset)
                size[k], loss[k] = item.end - item.start, item.loss(item.end)
                offset, room, segments, room_loss = offset + n, room - n, segments - 1, room_loss - used
            self.next += 1
        self.items = [i for i, t in zip(items, there) if t]


PIECES = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, loss_tokens long")
NAMES = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", prompt: str | None = None,
         tokenizer: str | None = None, limits: Limits = Limits(), with_ids: bool = False
         ) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    loss_tokens and, if asked for, ``ids`` (little-endian unsigned 32-bit).

    ``prompt`` names a column whose tokens come first and bear no loss, as in instruction
    data; the separator bears none either.  ``tokenizer`` is a path (default: the public
    50k byte-level file).  A null or empty text is the separator alone.  Rows with the
    same or a null key are packed like any others.  An empty table gives no rows.  Other
    columns are not read.
    """
    columns = [key, text] + ([prompt] if prompt else [])
    # Positions, not names: the input may have columns named like ours.
    rows = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(columns)])
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(tokenizer).encode
        packer = Packer(limits, TaskContext.get().partitionId())
        end = np.asarray([SEPARATOR], dtype="<u4").tobytes()

        def rows_out() -> pd.DataFrame:
            cells = list(zip(*packer.out)) if packer.out else [[]] * 9
            packer.out = []
            data = {"key": pd.Series(cells[0], dtype=object)}
            data |= {n: np.asarray(c, dtype=np.int64) for n, c in zip(NAMES, cells[1:8])}
            if with_ids:
                data["ids"] = pd.Series(cells[8], dtype=object)
            return pd.DataFrame(data)

        def parts(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
            """Rows whose texts are short enough together; a long text is a part alone."""
            sizes = batch["c1"].str.len().fillna(0).to_numpy(dtype=np.int64)
            groups = (np.cumsum(sizes) - sizes) // TOGETHER
            for _, part in batch.groupby(groups, sort=True):
                yield part

        def all_parts() -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield from parts(batch)
                give_back()  # a batch and its encodings are large beside what is remembered

        for part in all_parts():
            keys = part["c0"].astype(object).where(part["c0"].notna(), None)
            texts = code([t or "" for t in part["c1"]])
            before = code([q or "" for q in part["c2"]]) if prompt else [b""] * len(part)
            for k, t, q in zip(keys, texts, before):
                packer.add(k, q + t + end, len(q) // 4)
            yield rows_out()
        packer.pack()
        yield rows_out()

    schema = f"key {kind}, {PIECES}" + (", ids binary" if with_ids else "")
    run = given_back(run, lambda: encoder(tokenizer).forget())
    return rows.mapInPandas(run, schema).withColumnRenamed("key", key)
