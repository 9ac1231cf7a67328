"""Vector bin packing: sequences under simultaneous limits on tokens, segments and loss-bearing tokens.

Every task packs what it reads, in one pass and without a shuffle. A bounded number of pieces waits; an open sequence
always takes the waiting piece with the largest dot product of what it asks for and what the sequence has left, both in
shares of the limits, among those that fit in all three. Where pieces may be cut and none fits, the longest gives up
its head to fill the sequence, so a sequence stays short only where its segments or loss-bearing tokens run
out. At the end of a task the capacity shrinks to the powers of two that what is left is made of.

``packed_documents`` cuts and packs token ids of texts (every id but the first of a document bears loss: it has something
before it); ``packed_examples`` places whole instruction examples by given counts. A sequence's number holds the task's
in its upper bits, so the packing depends on the split of the files but not on timing: a task that
runs again gives the same sequences. Write the result before several jobs read it.

A tokenizer is the content of a file of the tokenizers library. With one that is byte-level and merges in the order of its ids,
a word with one space or line end before it, next to no other white space, has the same ids in every text, so the
distinct words of some MB of texts are encoded once, by the ranks of the same vocabulary (tests compare with the
library), and the texts are put together from them. Texts with other white space are encoded as a whole in the same way, long ones
in parts of about 1 MB cut before such a space; texts that hold a special token, and texts of any other tokenizer, by the library.

Nulls and empties: a null or empty text is its closing id alone; a null doc_id stays null; repeated rows are packed as often as they
come. Examples with null counts count as 0 tokens; an example beyond a limit by itself stands alone in a sequence marked
``oversize``. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_lens.llm.catalog import query, table


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most."""

    tokens: int = 1024
    segments: int = 128
    loss: int = 1024


#: Pieces that wait in a task, and pieces that it hands over at once.
WAITING, AT_ONCE = 1024, 4096
#: Text that is tokenized at once; longer texts are taken in parts.
BATCH_BYTES = 16 << 20
PART_BYTES = 1 << 20
CLOSING_ID = 0


# --- tokens ---------------------------------------------------------------------------


class TextIds:
    """Ids of many texts at once, by the tokenizer of ``tokenizer_json``, each with the closing id behind it."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.special = [token["content"] for token in json.loads(tokenizer_json).get("added_tokens") or []]
        self.ranked = _same_by_ranks(tokenizer_json)
        self.closing = np.array([CLOSING_ID], np.uint32)
        if self.ranked:
            self.line_end = self.ranked.encode_ordinary("\n")[0]

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts): all ids behind each other, and where each text starts; the end comes last."""
        texts = pc.fill_null(texts, "")
        if self.ranked is None:
            return _joined([np.append(np.array(self._by_library(t), np.uint32), self.closing) for t in texts.to_pylist()])
        alone = pc.greater(pc.binary_length(texts), PART_BYTES)
        for token in self.special:
            alone = pc.or_(alone, pc.match_substring(texts, token))
        # A line end counts as a space before the word it starts; where it stands next to other white space the text is loose.
        spaced = pc.replace_substring(pc.if_else(alone, "", texts), "\n", " \n")
        lists = pc.split_pattern(spaced, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets, words = offsets - offsets[0], lists.flatten()
        coded = pc.dictionary_encode(words)
        codes, distinct = coded.indices.to_numpy(), coded.dictionary
        loose = pc.match_substring_regex(distinct, _BLANK_EDGE).to_numpy(zero_copy_only=False)
        filled = pc.greater(pc.binary_length(spaced), 0).to_numpy(zero_copy_only=False)
        odd = alone.to_numpy(zero_copy_only=False)
        if loose[codes[offsets[:-1]]].any() or loose.sum() > 1:  # more than the empty word of empty texts
            odd = odd | (filled & np.logical_or.reduceat(loose[codes], offsets[:-1]))

        line_starts = pc.starts_with(distinct, "\n").to_numpy(zero_copy_only=False) & ~loose
        plain = ~loose & ~line_starts
        firsts = words.take(pa.array(offsets[:-1])).to_pylist()
        # Only first words of texts with no odd white space are needed; a letter stands in for the others.
        used = filled & ~odd
        firsts = [w if u else "a" for u, w in zip(used.tolist(), firsts)]
        plain_ids, plain_starts = self._of_lines([" " + w for w in distinct.filter(pa.array(plain)).to_pylist()])
        line_ids, line_at = self._of_lines([w[1:] for w in distinct.filter(pa.array(line_starts)).to_pylist()])
        first_ids, first_starts = self._of_lines(firsts)
        # One pool of ids, a line end in front of every word: closing id, words at a space, words at a line start, first words.
        pool = np.concatenate([self.closing, plain_ids, line_ids, first_ids])
        start, length = np.zeros(len(distinct), np.int32), np.zeros(len(distinct), np.int32)
        start[plain], length[plain] = plain_starts[:-1] + 2, np.diff(plain_starts) - 1
        start[line_starts], length[line_starts] = line_at[:-1] + 1 + len(plain_ids), np.diff(line_at)
        piece_start, piece_length, head = start[codes], length[codes], offsets[:-1]
        piece_start[head] = first_starts[:-1] + 2 + len(plain_ids) + len(line_ids)
        piece_length[head] = (np.diff(first_starts) - 1) * used
        ends = offsets[1:]  # every text ends with the closing id
        ids, at = _gathered(pool, np.insert(piece_start, ends, 0), np.insert(piece_length, ends, 1))
        starts = at[offsets + np.arange(len(offsets))]
        if not odd.any():
            return ids, starts
        return _joined([self._of_odd(texts[k].as_py()) if o else ids[starts[k] : starts[k + 1]] for k, o in enumerate(odd.tolist())])

    def _by_library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _of_lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of words without line ends, none empty: all as lines of one text, a line end in front of each."""
        ids = np.array(self.ranked.encode_ordinary("".join(["\n" + w for w in words])), np.uint32)
        starts = np.flatnonzero(ids == self.line_end)
        if len(starts) != len(words):
            raise ValueError("a word holds a line end")
        return ids, np.append(starts, len(ids))

    def _of_odd(self, text: str) -> np.ndarray:
        """One text by itself: a long one in parts, one with special tokens by the library."""
        if any(token in text for token in self.special):
            return np.append(np.array(self._by_library(text), np.uint32), self.closing)
        parts, start = [], 0
        while start < len(text):
            cut = _safe_space(text, start + PART_BYTES)
            parts.append(np.array(self.ranked.encode_ordinary(text[start:cut]), np.uint32))
            start = cut
        return np.concatenate([*parts, self.closing])


#: A word that is empty or has white space of any kind at an end, but for the line end in front.
_BLANK_EDGE = r"^\n?$|^[\t\x{0b}-\r\x{85}\pZ]|^\n[\t-\r\x{85}\pZ]|[\t-\r\x{85}\pZ]$"


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.empty(0, np.uint32), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])


def _gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``pool`` behind each other, and where each starts and the last one ends."""
    at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return pool[np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])], at


def _safe_space(text: str, at: int) -> int:
    """The first space from ``at`` on that has something other than white space on both sides; else the end."""
    while 0 <= (at := text.find(" ", at)) < len(text) - 1:
        if not text[at - 1].isspace() and not text[at + 1].isspace():
            return at
        at += 1
    return len(text)


#: Fixed value: how byte-level tokenizers of this family cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _same_by_ranks(tokenizer_json: str):
    """An encoding that merges by the ids of the results, where the tokenizer is byte-level and its merges come in the order of
    these ids, so that both give the same ids; else None."""
    import tiktoken

    content = json.loads(tokenizer_json)
    model, cuts = content["model"], content.get("pre_tokenizer") or {}
    plain = cuts.get("type") == "ByteLevel" and not cuts.get("add_prefix_space") and cuts.get("use_regex", True) and content.get("normalizer") is None
    if not plain or model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
        return None
    # Bytes that print stand for themselves, the others for the characters from 256 on.
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in prints]
    byte_of = {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(hidden)}
    special = {token["content"] for token in content.get("added_tokens") or []}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    results = [vocabulary.get("".join(pair)) for pair in pairs]
    if None in results or any(a >= b for a, b in zip(results, results[1:])) or len(vocabulary) != len(results) + 256 or (results and min(results) <= max(vocabulary.get(c, 1 << 31) for c in byte_of)):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}
    return tiktoken.Encoding("by_ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


# --- placing --------------------------------------------------------------------------


class Packer:
    """Places pieces of (tokens, loss) under ``limits``; ``placed`` collects (piece, start, length, sequence, offset)."""

    def __init__(self, limits: Limits, cut: bool, first_sequence: int = 0):
        self.limits, self.cut, self.next = limits, cut, first_sequence
        self.tokens, self.loss = np.zeros(WAITING, np.int64), np.zeros(WAITING, np.int64)  # of what waits
        self.items: list = [None] * WAITING  # (piece, start, loss-free tokens at its head)
        self.n = 0
        self.placed: list[tuple] = []

    def add(self, piece, tokens: int, loss: int) -> None:
        """A whole piece; one that may be cut bears loss on its last ``loss`` tokens."""
        if self.cut:
            free, start = tokens - loss, 0
            while tokens - start >= self.limits.tokens and self._loss(start, self.limits.tokens, free) <= self.limits.loss:
                self._alone(piece, start, self.limits.tokens)
                start += self.limits.tokens
            if start < tokens:
                self._wait(piece, start, tokens - start, free)
        elif tokens > self.limits.tokens or loss > self.limits.loss or self.limits.segments < 1:
            self._alone(piece, 0, tokens)
        else:
            self._wait(piece, 0, tokens, tokens - loss)
        while self.n == WAITING:
            self._sequence(self.limits.tokens)

    def finish(self) -> None:
        while self.n:
            left = int(self.tokens[: self.n].sum())
            shrink = self.cut and 0 < left < self.limits.tokens
            self._sequence(1 << (left.bit_length() - 1) if shrink else self.limits.tokens)

    @staticmethod
    def _loss(start: int, tokens: int, free: int) -> int:
        return tokens - min(max(free - start, 0), tokens)

    def _alone(self, piece, start: int, tokens: int) -> None:
        self.placed.append((piece, start, tokens, self.next, 0))
        self.next += 1

    def _wait(self, piece, start: int, tokens: int, free: int) -> None:
        k = self.n
        self.tokens[k], self.loss[k], self.items[k] = tokens, self._loss(start, tokens, free), (piece, start, free)
        self.n += 1

    def _taken(self, k: int):
        """Remove the waiting piece ``k``; the last one takes its place."""
        item, tokens, loss = self.items[k], int(self.tokens[k]), int(self.loss[k])
        self.n = n = self.n - 1
        self.tokens[k], self.loss[k], self.items[k] = self.tokens[n], self.loss[n], self.items[n]
        self.items[n] = None
        return *item, tokens, loss

    def _sequence(self, capacity: int) -> None:
        """Fill one sequence of ``capacity`` tokens."""
        most = [max(x, 1) for x in (self.limits.tokens, self.limits.segments, self.limits.loss)]
        tokens_left, segments_left, loss_left, offset, before = capacity, self.limits.segments, self.limits.loss, 0, len(self.placed)
        while self.n and segments_left:
            tokens, loss = self.tokens[: self.n], self.loss[: self.n]
            fits = (tokens <= tokens_left) & (loss <= loss_left)
            # Demand times what is left, both in shares of the limits; every piece asks for one segment.
            score = tokens * (tokens_left / most[0] ** 2) + loss * (loss_left / most[2] ** 2) + segments_left / most[1] ** 2
            k = int(np.where(fits, score, -1.0).argmax())
            if fits[k]:
                piece, start, _, taken, lost = self._taken(k)
                self.placed.append((piece, start, taken, self.next, offset))
            elif self.cut and tokens_left:
                piece, start, free, whole, _ = self._taken(int(tokens.argmax()))
                # As many tokens as there is room for, of which the loss-free head costs no loss.
                taken = min(tokens_left, loss_left + max(free - start, 0), whole)
                if taken:
                    lost = self._loss(start, taken, free)
                    self.placed.append((piece, start, taken, self.next, offset))
                if taken < whole:
                    self._wait(piece, start + taken, whole - taken, free)
                if not taken:
                    break
            else:
                break
            tokens_left, segments_left, loss_left, offset = tokens_left - taken, segments_left - 1, loss_left - lost, offset + taken
        if self.n and len(self.placed) == before:
            raise ValueError("the limits admit no piece")
        self.next += 1


def _first_sequence() -> int:
    return TaskContext.get().partitionId() << 33


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about BATCH_BYTES of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = sizes[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(sizes, before + BATCH_BYTES, side="right")))
        yield batch.slice(first, end - first)
        first = end


def packed_documents(docs: DataFrame, tokenizer_json: str, limits: Limits = Limits()) -> DataFrame:
    """(doc_id, start, length, doc_tokens, loss_tokens, ids, sequence_id, offset) of every piece of ``docs(doc_id, text)``;
    ``ids`` are little-endian unsigned 32-bit integers. ``tokenizer_json`` is the content of a tokenizer's file."""
    if limits.tokens < 1 or limits.segments < 1 or limits.loss < 1:
        raise ValueError("every limit has to be 1 at least")
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a vocabulary
    names = ["doc_id", "start", "length", "doc_tokens", "loss_tokens", "ids", "sequence_id", "offset"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches):
        tokenizer, packer = TextIds(shared.value), Packer(limits, cut=True, first_sequence=_first_sequence())

        def handed_over():
            rows = []
            for (doc_id, tokens, base, ids), start, length, sequence, offset in packer.placed:
                loss = length - (start + base == 0)
                rows.append((doc_id, start + base, length, tokens, loss, ids[4 * start : 4 * (start + length)], sequence, offset))
            packer.placed = []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        def cut_off(doc_id, ids):
            """Whole sequences at the head of a document stand alone, in parts; the rest waits without them."""
            tokens = len(ids) // 4
            whole = tokens - tokens % limits.tokens if limits.loss >= limits.tokens else 0
            step = AT_ONCE * limits.tokens
            for base in range(0, whole, step):
                part = ids[4 * base : 4 * min(base + step, whole)]
                packer.add((doc_id, tokens, base, part), len(part) // 4, len(part) // 4 - (base == 0))
                if len(packer.placed) >= AT_ONCE:
                    yield handed_over()
            if whole < tokens:
                packer.add((doc_id, tokens, whole, ids[4 * whole :]), tokens - whole, tokens - whole - (whole == 0))

        for batch in batches:
            for part in _slices(batch):
                ids, starts = tokenizer.of_texts(part["text"])
                for doc_id, start, end in zip(part["doc_id"].to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                    yield from cut_off(doc_id, ids[start:end].astype("<u4").tobytes())
                    if len(packer.placed) >= AT_ONCE:
                        yield handed_over()
        packer.finish()
        if packer.placed:
            yield handed_over()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, loss_tokens bigint, ids binary, sequence_id bigint, offset bigint")


def packed_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Columns of ``examples(tokens, loss_tokens, ...)`` with ``sequence_id``, ``offset`` and ``oversize``: whole examples, never cut."""
    held = {"tokens", "loss_tokens"}
    rest = [c for c in examples.columns if c not in held]
    names = examples.columns

    def run(batches):
        packer = Packer(limits, cut=False, first_sequence=_first_sequence())

        def handed_over():
            rows = [(*row, sequence, offset, oversize) for (row, oversize), _, _, sequence, offset in packer.placed]
            packer.placed = []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [*kinds, pa.int64(), pa.int64(), pa.bool_()])], [*names, "sequence_id", "offset", "oversize"])

        for batch in batches:
            kinds = [f.type for f in batch.schema]
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                tokens, loss = row[t] or 0, row[w] or 0
                packer.add((row, tokens > limits.tokens or loss > limits.loss), tokens, loss)
                if len(packer.placed) >= AT_ONCE:
                    yield handed_over()
        packer.finish()
        if packer.placed:
            yield handed_over()

    t, w = names.index("tokens"), names.index("loss_tokens")
    if {"sequence_id", "offset", "oversize"} & set(rest):
        raise ValueError("give sequence_id, offset and oversize other names to keep them")
    schema = ", ".join(f"`{c}` {kind}" for c, kind in examples.dtypes)
    return examples.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint, oversize boolean")


def tokenizer_file(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


@query("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packed_documents(table(spark, sf_dir, "documents"), tokenizer_file(public_tokenizers.path("byte_bpe_50k.json")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
