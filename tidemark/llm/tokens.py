"""Token ids of a corpus as flat binary files that can be memory-mapped.

Documents are dealt to ordered parts by ``doc_id``. Each part is one pair of files on
shared storage: ``<part>-<attempt>.bin`` holds the ids of its documents one after the
other as unsigned little-endian integers (16 bits if the vocabulary allows), and
``<part>-<attempt>.idx`` the 64-bit offsets of the documents and their ids. A manifest
table lists the pair that each part committed, so files of failed or repeated task
attempts are never read. Prefix sums over the parts' totals give every part its base:
base plus local offset is a document's place in the whole corpus.

Defined cases: a null text is empty and yields only the end id; documents without an id
come first; rows that share an id, or have none, are in the order of a hash of their texts, by
which they are also dealt to parts; an empty table gives an empty manifest; other columns are
not read.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, blocks, flat_bytes, in_arrow, shared_folder, stored

MAGIC = b"TIDETOK1"
MANIFEST = "part int, path string, n_docs bigint, n_tokens bigint"

#: Words made of Latin letters and then ASCII signs (no apostrophe): such a word is two pieces for every
#: pre-tokenizer that separates letters from signs, and none of its characters composes with another.
_SIMPLE = r"^(?P<letters>[a-zß-öø-ÿ]+)(?P<signs>[!-&(-/:-@\[-`{-~]*)\z"
#: Bytes in lower case, line ends as blanks.
_PLAIN = LOWER.copy()
_PLAIN[0x0A] = 0x20
#: Words that a process remembers of each kind; a full memory starts anew.
MEMORY_WORDS = 300_000
#: Bytes of text that are encoded at once; a longer text is encoded alone.
CODED_BYTES = 2 << 20
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)


class Encoder:
    """A tokenizer of the tokenizers library with a memory for words; ids come as little-endian bytes.

    The tokenizer normalises to lower case, drops white space and never joins characters
    across it, so a text's ids are those of its words in turn. Each distinct word goes
    through the library once: plain Latin words straight to its model (in the byte alphabet
    of its byte-level pre-tokenizer), all others through the whole tokenizer. Texts with
    special-token strings are encoded whole. Tokenizers of another make are used whole.
    """

    def __init__(self, path: str, end_id: int = 0):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        largest = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        self.kind = np.dtype("<u2" if largest <= 1 << 16 else "<u4")
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {ord(c): alphabet.pre_tokenize_str(c)[0][0] for c in _LETTERS}
        probe = ["the", "größe", "élan", "ñ", "s", "straße", "internationalisation"]
        whole = lambda w: self.tokenizer.encode(w, add_special_tokens=False).ids
        self.by_model = all(whole(w) == self._model_ids(w) for w in probe)
        self.by_word = self.by_model and whole("Ab, c.\nD") == [t for w in ("ab", ",", "c", ".", "d") for t in whole(w)]
        self.letters: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _model_ids(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word.translate(self.bytes))]

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _learn_letters(self, words: list[str]) -> None:
        """Ids of new words of letters alone: one text of all, cut by the number of each id's word."""
        if not words:
            return
        coded = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        number = np.array(coded.word_ids, np.int64)
        if len(number) and number[-1] == len(words) - 1 and (np.diff(number) <= 1).all():
            packed, width = self._pack(coded.ids), self.kind.itemsize
            cut = (np.searchsorted(number, np.arange(len(words) + 1)) * width).tolist()
            self.letters.update(zip(words, [packed[a:b] for a, b in zip(cut, cut[1:], strict=False)], strict=True))
        else:
            self.letters.update((w, self._pack(self._model_ids(w))) for w in words)

    def _learn(self, words: list[str]) -> None:
        parts = pc.extract_regex(pa.array(words, pa.large_string()), _SIMPLE)
        letters, signs = (pc.struct_field(parts, k).to_numpy(zero_copy_only=False).tolist() for k in (0, 1))
        needed = set(letters) - {None}
        if len(self.letters) + len(needed) > MEMORY_WORDS:
            self.letters.clear()
        self._learn_letters(list(needed - self.letters.keys()))
        other = [w for w, found in zip(words, letters, strict=True) if found is None]
        other += list(set(signs) - {None, ""} - self.words.keys() - set(other))
        for word, coded in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self.words[word] = self._pack(coded.ids)
        known, ids = self.words, self.letters
        known[""] = b""
        known.update((w, ids[a] + known[b]) for w, a, b in zip(words, letters, signs, strict=True) if a is not None)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the bounds of each text in them.

        Words are told apart in Arrow and each distinct word of the texts is looked up once;
        ids of all words are then taken by number.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.by_word or any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.special):
            coded = [np.array(c.ids, self.kind) for c in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            bounds = np.concatenate([[0], np.cumsum([len(c) for c in coded], dtype=np.int64)])
            return np.concatenate([np.zeros(0, self.kind), *coded]), bounds
        data, offsets = flat_bytes(texts)
        plain = pa.py_buffer(_PLAIN[data].tobytes())
        words = pc.split_pattern(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), plain), " ")
        coded = pc.list_flatten(words).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in distinct if w not in self.words]
        if len(self.words) + len(new) > MEMORY_WORDS:
            self.words.clear()
            new = distinct
        if new:
            self._learn(new)
        known = [self.words[w] for w in distinct]
        ends = np.cumsum([len(k) // self.kind.itemsize for k in known], dtype=np.int64)
        starts = np.concatenate([[0], ends])[:-1].astype(np.int64)
        number = coded.indices.to_numpy()
        lengths = (ends - starts)[number]
        before = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(starts[number] - before[:-1], lengths) + np.arange(before[-1])
        first_word = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])
        return np.frombuffer(b"".join(known), self.kind)[at], before[first_word]


_encoders: dict[str, Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """One encoder per process, so its memory serves all tasks of a worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, end_id)
    return _encoders[path]


def _writer(folder: str, vocabulary: str, end_id: int):
    def run(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        coder = encoder(vocabulary, end_id)
        width = coder.kind.itemsize
        part = TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        name = f"{part:06d}-{uuid.uuid4().hex}"
        ids, lengths = [], [0]
        with fs.open_output_stream(f"{root}/{name}.bin") as out:
            for block in blocks(batches, "text", CODED_BYTES):
                ids.append(block.column("doc_id"))
                coded, bounds = coder.encode(block.column("text"))
                own = np.diff(bounds)
                row = np.full(len(coded) + len(own), end_id, coder.kind)
                row[np.arange(len(coded)) + np.repeat(np.arange(len(own)), own)] = coded
                out.write(row.tobytes())
                lengths.extend((own + 1).tolist())
        if not ids:
            fs.delete_file(f"{root}/{name}.bin")
            return
        offsets = np.cumsum(lengths).astype("<u8")
        doc_ids = pa.chunked_array(ids).combine_chunks()
        with fs.open_output_stream(f"{root}/{name}.idx") as out:
            out.write(MAGIC + np.array([len(doc_ids), width], "<u8").tobytes() + offsets.tobytes())
            out.write(doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes())
            out.write(doc_ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
        row = [part], [f"{folder}/{name}"], [len(doc_ids)], [int(offsets[-1])]
        names = ["part", "path", "n_docs", "n_tokens"]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=names)

    return run


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int, parts: int) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files below ``folder``; returns the manifest with each part's ``base``."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("turn"))
    rows = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "turn")
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "turn", "text").drop("turn")
    manifest = stored(in_arrow(rows, _writer(folder, vocabulary, end_id), MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class Part:
    """One pair of files: memory-mapped where the storage is local, read by range elsewhere."""

    def __init__(self, path: str):
        fs, root = pafs.FileSystem.from_uri(path)
        local = isinstance(fs, pafs.LocalFileSystem)
        with fs.open_input_stream(f"{root}.idx") as f:
            head = f.read()
        if head[:8] != MAGIC:
            raise ValueError(f"{path}.idx is not a token index")
        n, width = np.frombuffer(head, "<u8", 2, 8)
        n = int(n)
        self.kind = np.dtype(f"<u{int(width)}")
        self.offsets = np.frombuffer(head, "<u8", n + 1, 24).astype(np.int64)
        self.doc_ids = np.frombuffer(head, "<i8", n, 32 + 8 * n)
        self.has_id = np.frombuffer(head, np.uint8, n, 32 + 16 * n).astype(bool)
        self.file = pa.memory_map(f"{root}.bin") if local else fs.open_input_file(f"{root}.bin")

    def tokens(self, first: int, last: int) -> np.ndarray:
        """Ids of the documents ``first`` up to and without ``last``."""
        a, b = self.offsets[first], self.offsets[last]
        self.file.seek(int(a) * self.kind.itemsize)
        return np.frombuffer(self.file.read_buffer(int(b - a) * self.kind.itemsize), self.kind)


READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _reader(batches):
    _encoders.clear()  # all is written; a worker that lives on need not hold the words
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            part = Part(path)
            n = len(part.doc_ids)
            for at in range(0, n, 1024):
                to = min(n, at + 1024)
                ids = part.tokens(at, to).astype("<u4")
                cut = part.offsets[at : to + 1] - part.offsets[at]
                sums = [zlib.crc32(ids[a:b].data) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part.doc_ids[at:to], pa.int64(), mask=~part.has_id[at:to]),
                        pa.array(part.offsets[at:to] + base, pa.int64()),
                        pa.array(np.diff(cut), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )


def read(manifest: DataFrame, parts: int) -> DataFrame:
    """Per document, from the files: place in the corpus, number of ids, and their checksum."""
    return manifest.repartition(parts).mapInArrow(_reader, READ)


def round_trip(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write ``docs`` and read the files back."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read(write(docs, shared_folder(spark, "tokens"), vocabulary, end_id, parts), parts)
