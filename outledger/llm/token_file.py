"""Token ids in canonical length-limited Huffman code: writing and reading of binary files.

A file is a row of frames, each followed by one line feed (the record separator of the writer):

* head: ``HEAD``, u32 length, zlib of one code-length byte per id;
* blocks: ``BLCK``, u32 documents, u64 symbols, u32 symbols between checkpoints, u64 payload bytes,
  then per document i64 id, u8 is-null, u32 symbols, then u64 bit offset per checkpoint, then the
  payload. A block holds whole documents and needs nothing but the head to be decoded.

Codes are canonical (by length, then id), so lengths alone restore them. A checkpoint is the bit
position of every 256th symbol; the decoder runs all checkpoints of a block side by side, one table
look-up per symbol.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from outledger.llm import frames, pretokens

MAX_BITS = 16
CHECKPOINT = 256
BLOCK_SYMBOLS = 1 << 19
#: Distinct chunks of text that a worker remembers before it forgets all but the commonest.
REMEMBERED = 250_000
#: Rows of an Arrow batch whose ids are made, and held, at once; and whose ids are counted at once.
ROWS_TOGETHER, COUNTED_TOGETHER = 2_000, 500
#: Characters of several texts that are looked up together.
TOGETHER = 8_000_000
#: New chunks that are merged together.
LEARNED_TOGETHER = 5_000
#: Bytes of a row's ids that order the rows of one doc_id.
HEADED = 64
HEAD, BLOCK = "<4sI", "<4sIQIQ"


# ---------------------------------------------------------------- ids of texts


class Encoder:
    """Ids as the tokenizers library gives them.

    White space only separates in this vocabulary, so texts of plain Latin script are looked up
    by their distinct chunks; a new chunk is merged by the library, and the commonest are remembered. Other texts go to the
    library whole. Chunks stay in Arrow arrays; only new ones become strings.
    """

    #: Other scripts, and control characters: str.split() takes some of these for white space.
    NOT_PLAIN = re.compile("[\x00-\x08\x0e-\x1f\x7fİ\u0180-\U0010ffff]")
    #: A point, comma or bar that isn't a piece of its own once blanks are put around it.
    JOINED = re.compile(r"[.,|](?:(?=\S)|(?<=[^\w\s.,|].))")

    def __init__(self, path: str, end_id: int):
        # A batch of one gains nothing by threads.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = pretokens.tokenizer(path)
        self.words = pretokens.word_tokenizer(path)
        # The last token of a word has the suffix; no other has, as the pattern never leaves it inside a word.
        model = pretokens.vocabulary(path)["model"]
        suffix = model.get("end_of_word_suffix") or ""
        self.ends_word = np.zeros(max(model["vocab"].values()) + 1, bool)
        self.ends_word[[n for t, n in model["vocab"].items() if t.endswith(suffix)]] = True
        self.special = pretokens.special_pattern(path)
        self.special_ids = {t["content"]: t["id"] for t in pretokens.vocabulary(path)["added_tokens"]}
        #: Code point of each byte's stand-in; a blank's own stands between words.
        self.symbols = np.array([ord(c) for c in pretokens.byte_symbols()], "<u4")
        self.end_id = end_id
        self.forget()

    def forget(self) -> None:
        self.names = pa.array([], pa.large_string())
        self.flat = np.empty(1 << 20, np.uint32)
        self.starts = np.empty(1 << 18, np.int64)
        self.sizes = np.empty(1 << 18, np.int64)
        self.hits = np.zeros(1 << 18, np.int64)
        self.used = 0

    @property
    def number(self) -> dict[str, int]:
        """The number of each chunk that is remembered."""
        return dict(zip(self.names.to_pylist(), range(len(self.names)), strict=True))

    def keep_common(self) -> None:
        """Forget all but the chunks that came most often, more than once, at most half of those remembered."""
        hits = self.hits[: len(self.names)]
        kept = np.sort(np.argsort(-hits, kind="stable")[: REMEMBERED // 2])
        kept = kept[hits[kept] > 1]
        names, hits = self.names.take(pa.array(kept)), hits[kept] // 2
        starts, sizes = self.starts[kept], self.sizes[kept]
        _, inside = frames.ragged(sizes)
        flat = self.flat[np.repeat(starts, sizes) + inside]
        self.forget()
        self.names = names
        self.add(flat, sizes, 0)
        self.hits[: len(kept)] = hits

    def add(self, ids: list[int] | np.ndarray, lengths: np.ndarray, n: int) -> None:
        """Ids and lengths of the chunks numbered from `n`."""
        m = len(lengths)
        while n + m > len(self.sizes):
            self.sizes, self.starts = np.resize(self.sizes, 2 * len(self.sizes)), np.resize(self.starts, 2 * len(self.starts))
            self.hits = np.concatenate([self.hits, np.zeros(len(self.hits), np.int64)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.sizes[n : n + m] = lengths
        self.starts[n : n + m] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def learn(self, chunks: pa.Array) -> None:
        """The ids of new chunks: those of letters are words, others are put together from their words."""
        # Of the letters that a plain text has, the pattern takes all in a row as one word.
        letters = pc.utf8_is_alpha(chunks)
        self.learn_words(chunks.filter(letters))
        others = chunks.filter(pc.invert(letters))
        own = list(map(pretokens.WORD_END.findall, others.to_numpy(zero_copy_only=False)))
        counts = np.fromiter(map(len, own), np.int64, len(own))
        coded = pa.array(list(chain.from_iterable(own)), pa.large_string()).dictionary_encode()
        words, place = coded.dictionary, coded.indices.to_numpy()
        at, unknown = self.numbers(words)
        at[unknown] = len(self.names) + np.arange(len(unknown))
        self.learn_words(words.take(pa.array(unknown)))
        self.hits[at] += np.bincount(place, minlength=len(at))
        # A chunk of one word is that word.
        several = counts != 1
        ids, ends = self.gathered(at, place[np.repeat(several, counts)])
        self.add(ids, np.diff(ends[np.cumsum(counts[several])], prepend=0), len(self.names))
        self.names = pa.concat_arrays([self.names, others.filter(pa.array(several))])

    def learn_words(self, words: pa.Array) -> None:
        """The ids of new words, by the library's own model; some thousands at once, so that no token becomes an object."""
        for at in range(0, len(words), LEARNED_TOGETHER):
            fresh = words.slice(at, LEARNED_TOGETHER)
            joined = " ".join(fresh.to_numpy(zero_copy_only=False)).encode("utf-8")
            text = self.symbols[np.frombuffer(joined, np.uint8)].tobytes().decode("utf-32-le")
            ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(fresh):
                # A vocabulary without an end for some word.
                found = self.words.encode(text.split(chr(self.symbols[0x20])), is_pretokenized=True, add_special_tokens=False)
                ends = np.cumsum(np.bincount(np.array(found.word_ids, np.int64), minlength=len(fresh)))
            self.add(ids, np.diff(ends, prepend=0), len(self.names) + at)
        self.names = pa.concat_arrays([self.names, words])

    def gathered(self, at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks numbered `at[place]` in a row, and where each chunk ends in them, from 0."""
        sizes = self.sizes[at][place]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.flat[np.repeat(self.starts[at][place] - ends[:-1], sizes) + np.arange(ends[-1])], ends

    def padded(self, text: str) -> str:
        """A plain text whose chunks stand between white space."""
        text = text.lower()
        if self.JOINED.search(text) is None:
            text = text.replace(".", " . ").replace(",", " , ").replace("|", " | ")
        return text

    def numbers(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of distinct chunks, and the places of those that have none yet."""
        at = pc.fill_null(pc.index_in(chunks, value_set=self.names), -1).to_numpy().astype(np.int64)
        return at, np.flatnonzero(at < 0)

    def looked_up(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of padded texts; new chunks are learned once. A text's ends may give an empty chunk, which has no ids."""
        split = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        chunks, place = coded.dictionary, coded.indices.to_numpy()
        at, unknown = self.numbers(chunks)
        if len(unknown):
            if len(self.names) + len(unknown) > REMEMBERED and len(self.names):
                self.keep_common()
                at, unknown = self.numbers(chunks)
            self.learn(chunks.take(pa.array(unknown)))
            at, _ = self.numbers(chunks)
        self.hits[at] += np.bincount(place, minlength=len(at))
        ids, ends = self.gathered(at, place)
        cuts = ends[split.offsets.to_numpy()].tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def ids(self, text: str) -> np.ndarray:
        return self.batch([text])[0]

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of several texts: their plain parts are looked up together."""
        out: list[list] = [[] for _ in texts]
        waiting, plain, held = [], [], 0

        def look_up() -> None:
            for (k, n), ids in zip(waiting, self.looked_up(plain) if plain else [], strict=True):
                out[k][n] = ids
            waiting.clear(), plain.clear()

        for k, text in enumerate(texts):
            parts, last = [], 0
            for found in self.special.finditer(text):
                parts += [text[last : found.start()], self.special_ids[found[0]]]
                last = found.end()
            for part in [*parts, text[last:], self.end_id]:
                if isinstance(part, int):
                    out[k].append(np.array([part], np.uint32))
                elif self.NOT_PLAIN.search(part):
                    out[k].append(np.array(self.library.encode(part, add_special_tokens=False).ids, np.uint32))
                else:
                    waiting.append((k, len(out[k])))
                    out[k].append(None)
                    plain.append(self.padded(part))
                    held += len(part)
            if held > TOGETHER:
                look_up()
                held = 0
        look_up()
        return [np.concatenate(parts) for parts in out]


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    """One per worker process: what a task has learned serves the next."""
    return Encoder(path, end_id)


def id_width(vocabulary: str, end_id: int) -> int:
    """Bytes that hold any id of the vocabulary: 2 or 4."""
    found = pretokens.vocabulary(vocabulary)
    largest = max([*found["model"]["vocab"].values(), *(t["id"] for t in found["added_tokens"]), end_id])
    return 2 if largest < 1 << 16 else 4


def token_ids(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, width: int = 4
) -> DataFrame:
    """doc_id and ids (little-endian, `width` bytes each) of every row; a NULL text is an empty one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS_TOGETHER):
                rows = batch.iloc[at : at + ROWS_TOGETHER]
                found = encoder(vocabulary, end_id).batch([t or "" for t in rows["text"]])
                ids = [x.astype(f"<u{width}").tobytes() for x in found]
                yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "ids": ids})

    rows = frames.pick(df, doc_id=id_col, text=text_col)
    return rows.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, ids binary")


# ---------------------------------------------------------------- the code


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most `max_bits` (package-merge); 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids don't fit codes of {max_bits} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    level, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(max_bits - 1):
        half = len(level) // 2 * 2
        both = np.concatenate([leaves, level[:half:2] + level[1:half:2]])
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        is_leaf.append(rank < len(leaves))
    take = 2 * len(leaves) - 2
    for flags in reversed(is_leaf):
        n = int(flags[:take].sum())
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    return lengths


@lru_cache(maxsize=4)
def canonical(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code and length of each id, and the decoding table: id and length by the next 16 bits."""
    lengths = np.frombuffer(zlib.decompress(packed), np.uint8).astype(np.int64)
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    size = 1 << (MAX_BITS - lengths[ids])
    first = np.cumsum(size) - size
    codes = np.zeros(len(lengths), np.uint64)
    codes[ids] = first >> (MAX_BITS - lengths[ids])
    by_id, by_length = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.int64)
    filled = int(size.sum())
    by_id[:filled] = np.repeat(ids, size)
    by_length[:filled] = np.repeat(lengths[ids], size)
    return codes, lengths, by_id, by_length


def pack(symbols: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The payload, and the bit position of every 256th symbol."""
    size = lengths[symbols]
    ends = np.cumsum(size)
    starts = ends - size
    words = np.zeros(int(ends[-1] >> 6) + 2 if len(ends) else 1, np.uint64)
    if len(ends):
        code, word, offset = codes[symbols], starts >> 6, starts & 63
        room = 64 - offset - size
        over = room < 0
        first = np.where(over, code >> np.where(over, -room, 0).astype(np.uint64), code << np.where(over, 0, room).astype(np.uint64))
        group = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[group]] = np.bitwise_or.reduceat(first, group)
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    payload = words.astype(">u8").tobytes()[: (int(ends[-1]) + 7) // 8 if len(ends) else 0]
    return payload, starts[::CHECKPOINT].astype("<u8")


def unpack(payload: bytes, n: int, every: int, at: np.ndarray, by_id, by_length) -> np.ndarray:
    """All lanes, one per checkpoint, take one symbol per step."""
    raw = np.frombuffer(payload + b"\0\0\0", np.uint8)
    # The 24 bits from each byte on.
    ahead = raw[:-2].astype(np.int32) << 16
    ahead |= raw[1:-1].astype(np.int32) << 8
    ahead |= raw[2:]
    out = np.empty((every, len(at)), np.uint32)
    position = at.astype(np.int64)
    for step in range(min(every, n)):
        window = ahead.take(position >> 3, mode="clip") >> (8 - (position & 7)) & 0xFFFF
        by_id.take(window, out=out[step])
        position += by_length.take(window)
    return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------- files


def _block(docs: list[tuple[int | None, np.ndarray]], codes: np.ndarray, lengths: np.ndarray) -> bytes:
    symbols = np.concatenate([ids for _, ids in docs])
    payload, at = pack(symbols, codes, lengths)
    keys = np.array([0 if k is None else k for k, _ in docs], "<i8")
    null = np.array([k is None for k, _ in docs], np.uint8)
    sizes = np.array([len(ids) for _, ids in docs], "<u4")
    head = struct.pack(BLOCK, b"BLCK", len(docs), len(symbols), CHECKPOINT, len(payload))
    return b"".join([head, keys.tobytes(), null.tobytes(), sizes.tobytes(), at.tobytes(), payload])


def write_tokens(
    ids: DataFrame, folder: str, tokens_per_file: int = 1 << 24, max_bits: int = MAX_BITS, width: int = 4
) -> None:
    """Write (doc_id, ids) in ascending doc_id order, NULL ids first; rows of one id by content.

    Rows that share an id come by their first HEADED bytes, then by a hash, so that an id with very many
    rows, equal ones too, takes several files. Ids take `width` bytes each in the frame. `ids` is read
    three times, so it should be a stored frame. What reaches the driver is one count per id of the
    vocabulary. A file holds about `tokens_per_file` symbols.
    """

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, len(batch), COUNTED_TOGETHER):
                n = np.bincount(np.frombuffer(b"".join(batch["ids"].iloc[at : at + COUNTED_TOGETHER]), f"<u{width}"))
                if len(n) > len(total):
                    total = np.pad(total, (0, len(n) - len(total)))
                total[: len(n)] += n
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    found = (
        ids.select("ids").mapInPandas(tally, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ).toPandas()
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 0, np.int64)
    counts[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    packed = zlib.compress(code_lengths(counts, max_bits).tobytes(), 9)
    files = max(1, math.ceil(int(counts.sum()) / tokens_per_file))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, lengths, _, _ = canonical(packed)
        docs, held, begun = [], 0, False
        for batch in batches:
            done = [] if begun else [struct.pack(HEAD, b"HEAD", len(packed)) + packed]
            begun = True
            for key, raw in zip(batch["doc_id"], batch["ids"], strict=True):
                symbols = np.frombuffer(raw, f"<u{width}")
                docs.append((None if pd.isna(key) else int(key), symbols))
                held += len(symbols)
                if held >= BLOCK_SYMBOLS:
                    done.append(_block(docs, codes, lengths))
                    docs, held = [], 0
            yield pd.DataFrame({"frame": done})
        if docs:
            yield pd.DataFrame({"frame": [_block(docs, codes, lengths)]})

    keys = [
        F.col("doc_id"), F.substring("ids", 1, HEADED).alias("head"), F.xxhash64("ids").alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    ]
    ordered = (
        ids.select(*keys, "ids")
        .repartitionByRange(files, "doc_id", "head", "tie", "row")
        .sortWithinPartitions("doc_id", "head", "tie", "row")
        .select("doc_id", "ids")
    )
    # The writer puts the bytes of a value out as they are.
    ordered.mapInPandas(encode, "frame binary").select(F.col("frame").cast("string")).write.option(
        "lineSep", "\n"
    ).text(folder)


def decoded(content: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Of each block of a file: document ids, symbols per document, all symbols."""
    if not content:
        return
    magic, size = struct.unpack_from(HEAD, content)
    if magic != b"HEAD":
        raise ValueError("not a token file")
    at = struct.calcsize(HEAD) + size
    _, _, by_id, by_length = canonical(bytes(content[struct.calcsize(HEAD) : at]))
    at += 1
    while at < len(content):
        magic, docs, n, every, size = struct.unpack_from(BLOCK, content, at)
        if magic != b"BLCK":
            raise ValueError(f"no block at byte {at}")
        at += struct.calcsize(BLOCK)
        keys = np.frombuffer(content, "<i8", docs, at)
        null = np.frombuffer(content, np.uint8, docs, at + 8 * docs)
        sizes = np.frombuffer(content, "<u4", docs, at + 9 * docs).astype(np.int64)
        at += 13 * docs
        lanes = -(-n // every)
        offsets = np.frombuffer(content, "<u8", lanes, at)
        at += 8 * lanes
        symbols = unpack(bytes(content[at : at + size]), n, every, offsets, by_id, by_length)
        at += size + 1
        yield [None if z else int(k) for k, z in zip(keys, null, strict=True)], sizes, symbols


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, file, start (symbols before it in its file), n_tokens, ids_crc32 and ids (u32 bytes).

    `ids` is left out with `with_ids=False`. Each file is decoded block by block.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                number, before = int(path.rsplit("/part-", 1)[1].split("-")[0]), 0
                for keys, sizes, symbols in decoded(content):
                    raw = symbols.astype("<u4").tobytes()
                    ends = np.cumsum(sizes)
                    each = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                    rows = {
                        "doc_id": pd.array(keys, "Int64"),
                        "file": number,
                        "start": before + ends - sizes,
                        "n_tokens": sizes,
                        "ids_crc32": [zlib.crc32(b) for b in each],
                    }
                    before += int(sizes.sum())
                    yield pd.DataFrame(rows | ({"ids": each} if with_ids else {}))

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    columns = "doc_id long, file long, start long, n_tokens long, ids_crc32 long"
    return files.mapInPandas(run, columns + (", ids binary" if with_ids else ""))


def token_table(
    df: DataFrame, vocabulary: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 2, tokens_per_file: int = 1 << 24,
) -> DataFrame:
    """Encode, write to `folder`, read back: doc_id, start, n_tokens, ids_crc32 of every row.

    `start` counts the ids of all rows before it in file order, `n_tokens` includes the end id. A
    NULL text is an empty one (the end id alone); rows with a NULL id come first; rows that share an
    id are all kept, by the bytes of their first ids; an empty table gives no rows. Ids must be whole
    numbers.
    """
    # The frame is stored and shuffled: no more bytes an id than the vocabulary needs.
    width = id_width(vocabulary, end_id)
    ids = frames.stored(token_ids(df, vocabulary, id_col, text_col, end_id, width), "token-ids")
    write_tokens(ids, folder, tokens_per_file, width=width)
    docs = frames.stored(read_tokens(df.sparkSession, folder, with_ids=False), "token-rows")
    # One row per file, not per document.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = docs.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    bases = totals.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    return docs.join(bases, "file").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )
