"""Operator 12: cost-balanced packing of documents into training sequences.

A piece of n tokens costs ``6 * width * n + n * n``: the linear part of a
transformer layer of that width and the quadratic part of attention inside the
piece. Documents are cut into pieces of a whole sequence and a rest. Rests are
packed block by block: a block of T tokens gets T // 1024 full sequences and,
for what is left, sequences of decreasing powers of two (which need no
padding), so its room is exactly its tokens. Rests go in descending order, each
to the sequence of least cost that has room for it; one that fits nowhere whole
is cut, and its parts go to the sequences of least cost with any room. So no
sequence is padded at all.

Ids are those of a ``tokenizers`` file. Where the file is a plain byte-level BPE
(no normalizer, merges in id order) its table is handed to ``tiktoken``, which
gives the same ids in a fifth of the time; any other file is run as it is.

Tokenizing and packing run inside the scan's tasks: nothing is shuffled, a task
holds one block (``BLOCK_TOKENS``) and one document, and a task that is run
again makes the same sequences (ids are the partition's number and a count).

Defined results: a null text is empty; every document ends with ``end_id``, so
an empty one is a single token; texts of any length are tokenized in segments
cut before a space or a line end, where no token can cross; equal lengths go in
table order, equal costs to the first sequence; repeated rows are documents of
their own; strings of special tokens are encoded as the tokenizer file has them;
a null doc_id is passed through; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE = 1024
WIDTH = 768              # layer width of the cost estimate
BLOCK_TOKENS = 1 << 21   # tokens packed together
SEGMENT_CHARS = 1 << 20  # longest stretch of a text tokenized at once
BATCH_CHARS = 1 << 20
_EMIT = 1 << 12          # pieces in an output batch
_BREAK = re.compile(r"\S[ \n]")
# Fixed value: the split of byte-level BPE files with ``use_regex``.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def cost(n, width: int = WIDTH):
    return 6 * width * n + n * n


def segments(text: str, longest: int = SEGMENT_CHARS) -> list[str]:
    """The text cut before a space or line end that follows another character, at most every ``longest`` characters."""
    out, at = [], 0
    while len(text) - at > longest:
        m = _BREAK.search(text, at + longest - 1)
        if m is None:
            break
        out.append(text[at:m.start() + 1])
        at = m.start() + 1
    out.append(text[at:])
    return out


def pack_rests(lengths: np.ndarray, sequence: int = SEQUENCE, width: int = WIDTH) -> list[tuple]:
    """Place rests shorter than a sequence: (index, start in the rest, length, sequence number, offset)."""
    total = int(lengths.sum())
    room = np.array([sequence] * (total // sequence)
                    + [1 << b for b in range(total.bit_length(), -1, -1) if total % sequence >> b & 1], dtype=np.int64)
    used, price = np.zeros(len(room), dtype=np.int64), np.zeros(len(room), dtype=np.int64)
    never = np.iinfo(np.int64).max
    out = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[i])
        while left:
            open_to = room - used
            whole = open_to >= left
            k = int(np.where(whole if whole.any() else open_to > 0, price, never).argmin())
            n = min(left, int(open_to[k]))
            out.append((i, start, n, k, int(used[k])))
            used[k] += n
            price[k] += cost(n, width)
            start, left = start + n, left - n
    return out


class _Packer:
    """Documents of one task, packed a block at a time."""

    def __init__(self, base: int, sequence: int, width: int):
        self.base, self.sequence, self.width = base, sequence, width
        self.next = 0
        self.rests: list[tuple] = []  # doc_id, start of the rest, ids, tokens of the document
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) // self.sequence * self.sequence
        for at in range(0, whole, self.sequence):  # a full piece is a sequence of its own
            self.rows.append((doc_id, at, self.sequence, ids[at:at + self.sequence].tobytes(), len(ids),
                              self.base + self.next, 0))
            self.next += 1
        if whole < len(ids):
            self.rests.append((doc_id, whole, ids[whole:].copy(), len(ids)))
            self.held += len(ids) - whole

    def close(self) -> None:
        if not self.rests:
            return
        placed = pack_rests(np.array([len(r[2]) for r in self.rests], dtype=np.int64), self.sequence, self.width)
        for i, at, n, k, offset in placed:
            doc_id, start, ids, total = self.rests[i]
            self.rows.append((doc_id, start + at, n, ids[at:at + n].tobytes(), total, self.base + self.next + k, offset))
        self.next += 1 + max(k for _, _, _, k, _ in placed)
        self.rests, self.held = [], 0

    def batches(self) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for at in range(0, len(self.rows), _EMIT):
            columns = zip(*self.rows[at:at + _EMIT])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        self.rows = []


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters for themselves, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _byte_ranks(file: dict) -> dict[bytes, int] | None:
    """Token bytes and ids of a plain byte-level BPE file, or None for any other kind."""
    model, split = file["model"], file.get("pre_tokenizer") or {}
    if (model.get("type") != "BPE" or file.get("normalizer") or model.get("dropout") or model.get("ignore_merges")
            or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
            or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex")):
        return None
    vocab, byte_of = model["vocab"], _byte_of()
    special = {t["content"] for t in file.get("added_tokens", ())}
    plain = {k: v for k, v in vocab.items() if k not in special}
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged) or len(plain) != len(merged) + 256 or any(c not in byte_of for k in plain for c in k):
        return None
    return {bytes(byte_of[c] for c in k): v for k, v in plain.items()}


def encoder(tokenizer_json: str) -> Callable[[list[str]], list[list[int]]]:
    """A function from texts to their ids, no special tokens added."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    file = json.loads(tokenizer_json)
    ranks = _byte_ranks(file)
    if ranks is not None:
        import tiktoken
        special = {t["content"]: t["id"] for t in file.get("added_tokens", ())}
        fast = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=special)
        return lambda texts: [fast.encode(t, allowed_special="all") for t in texts]
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(tokenizer_json)
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _encoded(encode: Callable, texts: list[str], end_id: int) -> list[np.ndarray]:
    cut = [segments(t) for t in texts]
    flat = encode([s for part in cut for s in part])
    out, at = [], 0
    for part in cut:
        ids = [np.array(e, dtype="<u4") for e in flat[at:at + len(part)]]
        at += len(part)
        out.append(np.concatenate([*ids, np.array([end_id], dtype="<u4")]))
    return out


def _pack(tokenizer_json: str, end_id: int, sequence: int, width: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_json)
        packer = _Packer(TaskContext.get().partitionId() << 40, sequence, width)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            lo = 0
            while lo < len(texts):
                some, chars, hi = [], 0, lo
                while hi < len(texts) and (not some or chars < BATCH_CHARS):
                    some.append(texts[hi].as_py() or "")
                    chars += len(some[-1])
                    hi += 1
                for doc_id, tokens in zip(ids.slice(lo, hi - lo).to_pylist(), _encoded(encode, some, end_id)):
                    packer.add(doc_id, tokens)
                    if packer.held >= block_tokens:
                        packer.close()
                    if len(packer.rows) >= _EMIT:
                        yield from packer.batches()
                lo = hi
        packer.close()
        yield from packer.batches()
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, sequence: int = SEQUENCE,
                   width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start and length in the document's ids, the ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id and the piece's
    offset there. The tokenizer file is read once, on the driver."""
    if sequence < 1 or sequence & (sequence - 1):
        raise ValueError("the sequence length must be a power of two")
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    return docs.select("doc_id", "text").mapInArrow(
        _pack(tokenizer_json, end_id, sequence, width, block_tokens), SCHEMA)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")
