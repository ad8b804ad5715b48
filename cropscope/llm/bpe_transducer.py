"""BPE encoding and decoding (operator 12): a minimal acyclic transducer of frequent words.

Words are counted over all documents. The most frequent ones (up to a stated number) are merged
once, on the driver, and compiled into a minimal acyclic automaton: words are added in
order, and a state whose arcs equal those of an earlier one is shared, so common endings
are stored once. Every arc carries a number; their sum along a word is the word's place in
the table of id sequences. The file is written below the shared folder, handed to every
executor by Spark, and memory-mapped by its workers, who share its pages.

Tasks look the distinct words of a slice up together, one byte a step. Words that are not
in the automaton are merged exactly, lowest rank first and then leftmost, long ones on a heap
with linked symbols (n log n for n bytes); so the lexicon changes the speed only.

Text is prepared as the vocabulary file states: composed, lower-cased, split into letter
runs, single digits, contractions and other runs, white space dropped. Latin-1 parts go
through one pattern; parts with other characters, told apart at white space, go through
the file's own normaliser and splitter. Special tokens spelt in a text have their own id.
Decoding joins the strings of the ids by spaces, as that file has no decoder of its own.

Defined cases: null, empty and blank texts have no ids and decode to the empty string; a
very long text is read in parts cut at white space and is never cut short; rows that share
an id are encoded separately, a null id is kept; an empty table compiles an empty lexicon.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import importable, pieces, stored

#: Words in the lexicon at most, and the longest of them in bytes; all others are merged.
LEXICON_WORDS, LONGEST_WORD = 1 << 15, 64
#: Bytes up to which a word is merged on a plain list, beyond on a heap.
SHORT_WORD = 40

_BITS = 20
_ID, _NONE = (1 << _BITS) - 1, 1 << 62

_LATIN_LETTERS = "a-zªµºß-öø-ÿ"
_LATIN_DIGITS = "0-9²³¹¼-¾"
_LATIN_SPACE = r"\t-\r \x85\xa0"
_LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN_LETTERS}]+|[{_LATIN_DIGITS}]"
                    f"|[^{_LATIN_SPACE}{_LATIN_LETTERS}{_LATIN_DIGITS}]+")
_PARTS = re.compile(r"[^\t-\r ]+")
_PREPARED = (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"])


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if it is a visible Latin-1
    character, else the next free one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """A BPE vocabulary with word ends, from a ``tokenizers`` file of the kind described above."""

    #: Merged words kept by each worker; all are forgotten beyond.
    cache_limit = 200_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = ([x["type"] for x in spec["normalizer"]["normalizers"]],
                 [x["type"] for x in spec["pre_tokenizer"]["pretokenizers"]])
        model = spec["model"]
        if kinds != _PREPARED or spec["decoder"] is not None or model["type"] != "BPE":
            raise ValueError(f"{path} is not a lower-case BPE vocabulary with word ends")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.whole = Tokenizer.from_file(path)
        letters = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        if max(vocab.values()) >> _BITS or len(model["merges"]) >> _BITS:
            raise ValueError(f"{path} has more than {1 << _BITS} ids or merges")
        # pair of ids -> rank and merged id, each packed into one number
        self.merges = {vocab[a] << _BITS | vocab[b]: rank << _BITS | vocab[a + b]
                       for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        strings = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in self.special.items()}}
        self.strings = [strings.get(i, "") for i in range(max(strings) + 1)]
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, list[str]] = {}

    def words(self, text: str) -> Iterator[list[str | int]]:
        """Prepared words in order, in lists; a special token is its id."""
        for piece in cut_at_space(text):
            if "<|" in piece:
                for k, part in enumerate(self.special_pattern.split(piece)):
                    yield [self.special[part]] if k % 2 else self._words(part)
            else:
                yield self._words(piece)

    def _words(self, text: str) -> list[str]:
        if _is_latin(text):
            return _LATIN.findall(_latin_lower(text))
        out: list[str] = []
        for part in _PARTS.findall(text):
            if _is_latin(part):
                out += _LATIN.findall(_latin_lower(part))
                continue
            got = self.parts.get(part)
            if got is None:
                if len(self.parts) >= self.cache_limit:
                    self.parts.clear()
                got = [bytes(map(self.byte_of.__getitem__, w)).decode("utf-8") for w, _ in
                       self.whole.pre_tokenizer.pre_tokenize_str(
                           self.whole.normalizer.normalize_str(part))]
                if len(part) <= LONGEST_WORD:
                    self.parts[part] = got
            out += got
        return out

    def merge(self, word: str) -> bytes:
        """Ids (uint32) of one prepared word, by merging the pair of lowest rank, the leftmost
        of equal ones, until none is left."""
        raw = word.encode("utf-8")
        tok = [self.inner[b] for b in raw[:-1]]
        tok.append(self.last[raw[-1]])
        return array("I", self._short(tok) if len(tok) <= SHORT_WORD else self._long(tok)).tobytes()

    def _short(self, tok: list[int]) -> list[int]:
        find = self.merges.get
        best = [find(a << _BITS | b, _NONE) for a, b in zip(tok, tok[1:])]
        while best:
            m = min(best)
            if m == _NONE:
                break
            i = best.index(m)
            new = m & _ID
            tok[i:i + 2] = [new]
            del best[i]
            if i:
                best[i - 1] = find(tok[i - 1] << _BITS | new, _NONE)
            if i < len(best):
                best[i] = find(new << _BITS | tok[i + 1], _NONE)
        return tok

    def _long(self, tok: list[int]) -> list[int]:
        n, find = len(tok), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i) for i in range(n - 1)
                if (m := find(tok[i] << _BITS | tok[i + 1], _NONE)) != _NONE]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i]
            if tok[i] < 0 or j >= n or find(tok[i] << _BITS | tok[j], _NONE) != m:
                continue  # one of its symbols has been merged since
            new = tok[i] = m & _ID
            tok[j] = -1
            k, h = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                if (m := find(new << _BITS | tok[k], _NONE)) != _NONE:
                    heapq.heappush(heap, (m, i))
            if h >= 0 and (m := find(tok[h] << _BITS | new, _NONE)) != _NONE:
                heapq.heappush(heap, (m, h))
        return [t for t in tok if t >= 0]

    def merged(self, word: str) -> bytes:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) >= self.cache_limit:
                self.cache.clear()
            got = self.merge(word)
            if len(word) <= LONGEST_WORD:
                self.cache[word] = got
        return got

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _latin_lower(text: str) -> str:
    return text.lower()  # Latin-1 stays Latin-1, one character for each


def cut_at_space(text: str, most: int = 1 << 20) -> Iterator[str]:
    """The text in parts of about ``most`` characters, each ending before white space."""
    at, space = 0, re.compile(r"[\t-\r ]")
    while len(text) - at > most:
        hit = space.search(text, at + most)
        if hit is None:
            break
        yield text[at:hit.start()]
        at = hit.start()
    yield text[at:] if at else text


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# --- the lexicon ---------------------------------------------------------------------

_MAGIC = 0x31584C4D
_ARRAYS = {"key": "<i8", "target": "<i4", "add": "<i4", "final": "u1", "at": "<i8", "ids": "<u4"}


def compile_lexicon(entries: dict[str, bytes]) -> bytes:
    """The automaton of ``entries`` (word -> ids) as one block: arcs sorted by (state, byte)
    with target and number, final marks of states, and the ragged table of ids."""
    words = sorted((w.encode("utf-8"), ids) for w, ids in entries.items())
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path = [0]  # states of the word added last, not yet compared with earlier ones

    def settle(depth: int, word: bytes) -> None:
        while len(path) - 1 > depth:
            s = path.pop()
            same = register.setdefault((final[s], tuple(arcs[s].items())), s)
            if same != s:
                arcs[path[-1]][word[len(path) - 1]] = same

    last = b""
    for w, _ in words:
        common = next((k for k, (a, b) in enumerate(zip(w, last)) if a != b), min(len(w), len(last)))
        settle(common, last)
        for b in w[common:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][b] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = w
    settle(0, last)
    number, order, stack = {0: 0}, [0], [0]  # states that are left, numbered
    while stack:
        for t in arcs[stack.pop()].values():
            if t not in number:
                number[t] = len(order)
                order.append(t)
                stack.append(t)
    reach: dict[int, int] = {}
    todo = [0]
    while todo:  # words below each state, children first
        s = todo[-1]
        missing = [t for t in arcs[s].values() if t not in reach]
        if missing:
            todo += missing
            continue
        todo.pop()
        reach[s] = final[s] + sum(reach[t] for t in arcs[s].values())
    key, target, add = [], [], []
    for s in order:
        before = int(final[s])
        for b, t in arcs[s].items():
            key.append(number[s] << 8 | b)
            target.append(number[t])
            add.append(before)
            before += reach[t]
    sizes = np.array([len(ids) // 4 for _, ids in words], np.int64)
    data = {"key": np.array(key, np.int64), "target": np.array(target, np.int64),
            "add": np.array(add, np.int64), "final": np.array([final[s] for s in order]),
            "at": np.concatenate(([0], np.cumsum(sizes))),
            "ids": np.frombuffer(b"".join(ids for _, ids in words), "<u4")}
    blocks = [data[c].astype(k).tobytes() for c, k in _ARRAYS.items()]
    head = np.array([_MAGIC, *(len(data[c]) for c in _ARRAYS)], "<i8").tobytes()
    return head + b"".join(b + b"\0" * (-len(b) % 8) for b in blocks)


class Lexicon:
    """A compiled lexicon over any buffer, such as a memory map."""

    def __init__(self, buffer: np.ndarray):
        head = buffer[:8 * (len(_ARRAYS) + 1)].view("<i8")
        if head[0] != _MAGIC:
            raise ValueError("not a compiled lexicon")
        at = 8 * (len(_ARRAYS) + 1)
        for (name, kind), n in zip(_ARRAYS.items(), head[1:].tolist()):
            size = n * np.dtype(kind).itemsize
            setattr(self, name, buffer[at:at + size].view(kind))
            at += size + -size % 8

    @property
    def states(self) -> int:
        return len(self.final)

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the table of ids, or -1; all words move on together."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.key) or not words:
            return out
        size = np.fromiter(map(len, words), np.int64, len(words))
        live = np.nonzero((size > 0) & (size <= LONGEST_WORD))[0]
        data = np.frombuffer(b"".join(words), np.uint8)
        at = (np.cumsum(size) - size)[live]
        state, place = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            want = state << 8 | data[at + step]
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            ok = self.key[arc] == want
            live, at, arc, place = live[ok], at[ok], arc[ok], place[ok]
            state, place = self.target[arc].astype(np.int64), place + self.add[arc]
            step += 1
            ended = size[live] == step
            done = ended & (self.final[state] == 1)
            out[live[done]] = place[done]
            live, at, state, place = (x[~ended] for x in (live, at, state, place))
        return out


@lru_cache(maxsize=2)
def mapped_lexicon(name: str) -> Lexicon:
    """The lexicon file that Spark brought to this executor, memory-mapped."""
    from pyspark import SparkFiles

    return Lexicon(np.memmap(SparkFiles.get(name), np.uint8, "r"))


def word_counts(docs: DataFrame, path: str, text_col: str = "text",
                most_held: int = 200_000) -> DataFrame:
    """(word, n) of every prepared word of all texts; summed in the task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, held = vocabulary(path), Counter()

        def emit() -> pa.RecordBatch:
            for i in vocab.special.values():
                held.pop(i, None)
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                ["word", "n"])
            held.clear()
            return out

        for whole in batches:
            for b in pieces(whole, 2 << 20):
                for t in b.column(0).to_pylist():
                    for words in vocab.words(t or ""):
                        held.update(words)
                if len(held) >= most_held:
                    yield emit()
        yield emit()

    return (docs.select(F.col(text_col).alias("_text")).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def shared_lexicon(spark: SparkSession, block: bytes) -> str:
    """Write a compiled lexicon below the shared folder and have Spark bring it to every
    executor, later ones too; its name there."""
    name = f"lexicon-{uuid.uuid4().hex[:12]}.bin"
    at = f"{shared_path(spark, 'llm', 'lexicon')}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(at)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(block))
    finally:
        out.close()
    spark.sparkContext.addFile(at)
    return name


def lexicon_of(docs: DataFrame, path: str, text_col: str = "text",
               most_words: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of the most frequent words, at most ``most_words``. Counts are
    gathered into classes an eighth of a power of two wide, and as many whole classes are
    taken as fit: only their few sizes and the words taken reach the driver."""
    counts = stored(word_counts(docs, path, text_col).where(
        F.octet_length("word") <= LONGEST_WORD), "word_counts").withColumn(
        "class", F.floor(8 * F.log2("n")).cast("int"))
    sizes = counts.groupBy("class").agg(F.count("*").alias("words")).orderBy(F.desc("class"))
    least, total = None, 0
    for r in sizes.collect():
        total += r["words"]
        if total > most_words:
            break
        least = r["class"]
    vocab = vocabulary(path)
    if least is None:
        return compile_lexicon({})
    top = counts.where(F.col("class") >= least).select("word")
    return compile_lexicon({r["word"]: vocab.merge(r["word"]) for r in top.collect()})


class _Numbers(dict):
    """Numbers words as they first come."""

    def __missing__(self, word: str | int) -> int:
        n = self[word] = len(self)
        return n


def encode_slice(texts: list[str | None], vocab: Vocabulary, lexicon: Lexicon) -> list[np.ndarray]:
    """Ids of each text; every distinct word is looked up, or merged, once."""
    number: dict[str | int, int] = _Numbers()
    seq = [np.concatenate([np.empty(0, np.int32), *(
        np.fromiter(map(number.__getitem__, w), np.int32, len(w)) for w in vocab.words(t or ""))])
        for t in texts]
    words = list(number)
    place = lexicon.places([w.encode("utf-8") if type(w) is str else b"" for w in words])
    known = place >= 0
    size = np.zeros(len(words), np.int64)
    size[known] = lexicon.at[place[known] + 1] - lexicon.at[place[known]]
    rest = [vocab.merged(words[k]) if type(words[k]) is str else array("I", [words[k]]).tobytes()
            for k in np.nonzero(~known)[0].tolist()]
    own = np.frombuffer(b"".join(rest), "<u4")
    size[~known] = np.fromiter(map(len, rest), np.int64, len(rest)) // 4
    # one table: the lexicon's ids of this slice's words, then those merged here
    first = np.concatenate(([0], np.cumsum(size)))[:-1]
    table = np.empty(int(size.sum()), "<u4")
    table[_spread(first[known], size[known])] = lexicon.ids[
        _spread(lexicon.at[place[known]], size[known])]
    table[_spread(first[~known], size[~known])] = own
    return [table[_spread(first[s], size[s])] for s in seq]


def _spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers as public

    return public.path(name)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     path: str | None = None, most_words: int = LEXICON_WORDS,
                     with_text: bool = True) -> DataFrame:
    """``_id, _ids`` (little-endian uint32) of every row and, if ``with_text``, ``_decoded``:
    the ids turned back into text."""
    spark = docs.sparkSession
    importable(spark)
    path = path or vocabulary_path()
    name = shared_lexicon(spark, lexicon_of(docs, path, text_col, most_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, lexicon = vocabulary(path), mapped_lexicon(name)
        for whole in batches:
            for b in pieces(whole, 2 << 20):
                ids = encode_slice(b.column(1).to_pylist(), vocab, lexicon)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([x.tobytes() for x in ids], pa.binary()),
                     pa.array([vocab.decode(x) if with_text else None for x in ids], pa.string())],
                    ["_id", "_ids", "_decoded"])

    out = (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
           .mapInArrow(run, "_id long, _ids binary, _decoded string"))
    return out if with_text else out.select("_id", "_ids")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``_id, _decoded`` of rows ``_id, _ids``; null ids decode to the empty string."""
    importable(encoded.sparkSession)
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for whole in batches:
            for b in pieces(whole, 2 << 20):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([vocab.decode(np.frombuffer(x or b"", "<u4"))
                                            for x in b.column(1).to_pylist()], pa.string())],
                    ["_id", "_decoded"])

    return encoded.select("_id", "_ids").mapInArrow(run, "_id long, _decoded string")
