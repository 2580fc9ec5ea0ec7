"""SentencePiece encoding and decoding: the last token of every prefix, found by an automaton and tests of token pairs."""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from islet.llm.common import enter, leave

SPACE = "▁"
#: Types of a model's pieces, and the fields of the model file read here, as its format numbers them.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK, SPACE_AS_SUFFIX = 3, 35, 24
NAME, PREFIX, EXTRA_SPACES = 1, 3, 4
#: Entries that a worker remembers of words (twice) and of token pairs; beyond, it forgets the older ones, with the same results.
REMEMBERED = 1 << 17


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, data[at : at + size]
            at += size


class Vocabulary:
    """The pieces of a BPE model, and how merges make each of them.

    ``rank`` orders merges (better scores first), ``left`` and ``right`` are the two tokens whose merge makes a token, or
    the token itself where it is one character. Tokens that merges never make out of their own text aren't ``whole``.
    """

    def __init__(self, model: bytes):
        self._coders = None
        pieces, trainer, normalizer = [], {}, {}
        for field, value in _fields(model):
            if field == PIECES:
                pieces.append(dict(_fields(value)))
            elif field == TRAINER:
                trainer = dict(_fields(value))
            elif field == NORMALIZER:
                normalizer = dict(_fields(value))
        if trainer.get(MODEL_TYPE) != 2 or not trainer.get(BYTE_FALLBACK) or trainer.get(SPACE_AS_SUFFIX):
            raise ValueError("only BPE models with byte fallback and spaces before words are read")
        if normalizer.get(NAME) != b"identity" or normalizer.get(EXTRA_SPACES, 1):
            raise ValueError("only models that leave texts as they are are read")
        self.prefix = bool(normalizer.get(PREFIX, 1))
        self.texts = [p[1].decode() for p in pieces]
        self.kinds = [p.get(3, NORMAL) for p in pieces]
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("models with user-defined or unused pieces aren't read")
        self.bytes = {int(t[3:5], 16): i for i, t in enumerate(self.texts) if self.kinds[i] == BYTE}
        scores = [struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces]
        ids = {t: i for i, t in enumerate(self.texts) if self.kinds[i] == NORMAL}
        #: Runs of the space mark share one score, so the leftmost merge of a run goes first: a rule of their own, below.
        self.runs = {len(t): i for t, i in ids.items() if not t.strip(SPACE)}
        self.ids = {t: i for t, i in ids.items() if t.strip(SPACE) or len(t) == 1}
        ordered = sorted((i for t, i in self.ids.items() if len(t) > 1), key=lambda i: -scores[i])
        if any(scores[a] == scores[b] for a, b in zip(ordered, ordered[1:])) or any(SPACE in self.texts[i][1:] for i in ordered):
            raise ValueError("pieces of several characters must have scores of their own, and spaces only in front")
        if any(scores[i] > scores[ordered[-1]] for n, i in self.runs.items() if n > 1):
            raise ValueError("runs of spaces must merge after all else")
        self.rank = [-1] * len(pieces)
        for n, i in enumerate(ordered):
            self.rank[i] = n
        self.left, self.right, self.whole = list(range(len(pieces))), list(range(len(pieces))), []
        for t, i in self.ids.items():
            made, last = self._merge(t)
            if made == [i]:
                self.whole.append(i)
                if last:
                    self.left[i], self.right[i] = last
                    if max(self.rank[last[0]], self.rank[last[1]]) > self.rank[i]:
                        raise ValueError("a piece must merge after its parts")

    def letters(self) -> set[str]:
        """Letters that no piece holds beside, or linked by others beside, anything but letters; pieces hold spaces in front alone."""
        above: dict[str, str] = {}

        def top(c: str) -> str:
            while above.setdefault(c, c) != c:
                c = above[c]
            return c

        for i in self.ids.values():
            text = self.texts[i].lstrip(SPACE)
            for a, b in zip(text, text[1:] or text):
                above[top(a)] = top(b)
        mixed = {top(c) for c in above if not c.isalpha()}
        return {c for c in above if top(c) not in mixed}

    def coders(self) -> tuple[Encoder, Decoder]:
        """The encoder and decoder of this process: later tasks of a worker go on with what it remembers."""
        if self._coders is None:
            self._coders = Encoder(self), Decoder(self)
        return self._coders

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_coders": None}

    def _merge(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """The tokens of a piece's own text by merging the best pair again and again, and the last merge."""
        now, last = [self.ids.get(c, -1) for c in text], None
        while True:
            best = None
            for k in range(len(now) - 1):
                got = self.ids.get(self.texts[now[k]] + self.texts[now[k + 1]]) if min(now[k], now[k + 1]) >= 0 else None
                if got is not None and (best is None or self.rank[got] < self.rank[best[1]]):
                    best = (k, got)
            if best is None:
                return now, last
            k, got = best
            last = (now[k], now[k + 1])
            now[k : k + 2] = [got]


class Encoder:
    """Encodes texts inside a task."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v, self.pairs, self.spaces = vocabulary, {}, {}
        #: Words' tokens: those used since the last change of generations, and those before.
        self.known, self.old = {}, {}
        self.sizes = [len(t) for t in vocabulary.texts]
        self.automaton = ahocorasick.Automaton()
        for i in vocabulary.whole:
            self.automaton.add_word(vocabulary.texts[i], (len(vocabulary.texts[i]), i))
        self.automaton.make_automaton()
        self.chars = {t for t in vocabulary.ids if len(t) == 1}
        #: A run of letters or of other characters, with the spaces before it: merges never cross these borders.
        letters = "".join(map(re.escape, sorted(vocabulary.letters())))
        self.word = re.compile(f"{SPACE}*(?:[{letters}]+|[^{letters}{SPACE}]+)|{SPACE}+" if letters else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def fit(self, a: int, b: int) -> bool:
        """Whether the text of tokens ``a`` and ``b`` encodes to just them.

        Undoes merges from the last one made, and asks of each pair that met at the border meanwhile whether it would have
        merged before its next merge: on equal ranks the left one goes first.
        """
        v = self.v
        ids, texts, rank = v.ids, v.texts, v.rank
        limit = len(rank)
        while True:
            met = ids.get(texts[a] + texts[b])
            if met is not None and rank[met] < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], v.right[a]
            elif rank[b] >= 0:
                limit, b = rank[b] + 1, v.left[b]
            else:
                return True

    def stretch(self, text: str) -> list[int]:
        """The tokens of characters that the vocabulary has: each prefix's last token in a table, then ids from the end.

        A prefix has one last token: the one that ends there, fits the last token of the prefix before it, or is the whole prefix.
        """
        last, found = [0] * (len(text) + 1), 0
        pairs, fit = self.pairs, self.fit
        for end, (size, token) in self.automaton.iter(text):
            end += 1
            if end == found:  # the tokens that end at a character come together, the longest first
                continue
            if size < end:
                key = last[end - size] << 20 | token
                if key in pairs:
                    if not pairs[key]:
                        continue
                else:
                    if len(pairs) >= REMEMBERED:
                        pairs.clear()
                    good = pairs[key] = fit(key >> 20, token)
                    if not good:
                        continue
            last[end] = token
            found = end
        out, at, sizes = [], len(text), self.sizes
        while at:
            token = last[at]
            out.append(token)
            at -= sizes[token]
        return out[::-1]

    def run(self, n: int) -> list[int]:
        """The tokens of ``n`` spaces that merged with nothing else: of pairs that form a longer run, the leftmost goes first."""
        if n not in self.spaces:
            runs, stack = self.v.runs, []
            for _ in range(n):
                stack.append(1)
                at = len(stack) - 2  # only pairs at or right of the newest change can merge
                while 0 <= at < len(stack) - 1:
                    if stack[at] + stack[at + 1] in runs:
                        stack[at : at + 2] = [stack[at] + stack[at + 1]]
                        at = at - 1 if at and stack[at - 1] + stack[at] in runs else at
                    else:
                        at += 1
            if len(self.spaces) >= 1024:
                self.spaces.clear()
            self.spaces[n] = [runs[k] for k in stack]
        return self.spaces[n]

    def _word(self, whole: str) -> list[int]:
        word = whole.lstrip(SPACE)
        spaces = len(whole) - len(word)
        if not word:
            return self.run(spaces)
        text = SPACE + word if spaces else word
        if self.chars.issuperset(text):
            out = self.stretch(text)
        else:
            out, at = [], 0
            while at < len(text):  # characters outside the vocabulary are bytes, and no merge crosses them
                end = at
                while end < len(text) and text[end] in self.chars:
                    end += 1
                if end > at:
                    out += self.stretch(text[at:end])
                if end < len(text):
                    out += [self.v.bytes[b] for b in text[end].encode()]
                at = end + 1
        if not spaces:
            return out
        if out[0] == self.v.ids.get(SPACE):
            return self.run(spaces) + out[1:]
        return self.run(spaces - 1) + out if spaces > 1 else out

    def _remember(self, whole: str) -> list[int]:
        got = self.old.get(whole)
        if got is None:
            got = self._word(whole)
        if len(whole) < 64:
            if len(self.known) >= REMEMBERED:
                self.known, self.old = {}, self.known
            self.known[whole] = got
        return got

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out = []
        for whole in self.word.findall((SPACE if self.v.prefix else "") + text.replace(" ", SPACE)):
            out += self.known.get(whole) or self._remember(whole)
        return out


def _bad_bytes(e: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (e.end - e.start), e.end


class Decoder:
    """Turns ids into text inside a task."""

    def __init__(self, vocabulary: Vocabulary):
        codecs.register_error("each-byte", _bad_bytes)
        self.v = vocabulary
        self.surface: list[bytes] = []
        #: What an unknown token is written as.
        unknown = " ⁇ ".encode()
        for t, kind in zip(vocabulary.texts, vocabulary.kinds):
            self.surface.append(b"" if kind == CONTROL else unknown if kind == UNKNOWN else b"" if kind == BYTE else t.replace(SPACE, " ").encode())
        self.byte = {i: b for b, i in vocabulary.bytes.items()}

    def decode(self, ids: list[int]) -> str:
        """Byte tokens in a row make UTF-8 together; every byte that doesn't is a replacement character. One space in front goes."""
        surface, byte, parts, run = self.surface, self.byte, [], bytearray()
        first = self.v.prefix
        for i in ids:
            if i in byte:
                run.append(byte[i])
                first = False
                continue
            if run:
                parts.append(run.decode("utf-8", "each-byte").encode())
                run = bytearray()
            piece = surface[i]
            if first and self.v.kinds[i] == NORMAL:
                first = False
                piece = piece[1:] if piece[:1] == b" " else piece
            elif self.v.kinds[i] == UNKNOWN:
                first = False
            parts.append(piece)
        if run:
            parts.append(run.decode("utf-8", "each-byte").encode())
        return b"".join(parts).decode()


def encode_pieces(df: DataFrame, model_file: str, *, text: str = "text", decode: bool = True) -> DataFrame:
    """Adds ``ids`` (array of int), exactly those of the sentencepiece library, and with ``decode`` the ``decoded`` text.

    A word's tokens come from its prefix table: an automaton names the tokens that end at each character, and the one that is
    compatible with the last token of the prefix before it is the prefix's last token, so time is linear in a text of any
    form. Tasks remember frequent words and pairs in tables of bounded size. Rows need no shuffle: text goes to tasks with the
    other columns and comes back with ids.

    ``model_file`` is the path of a BPE model with byte fallback and without normalisation, on the driver; its vocabulary (which
    does not grow with the data) goes to the executors as a broadcast. Other models raise ValueError.
    Null texts count as empty: no ids, empty decoded text. Repeated rows each have their own result; an empty table stays empty.
    Bytes that aren't UTF-8 count as replacement characters. Input columns called ids or decoded are replaced.
    """
    with open(model_file, "rb") as f:
        vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(f.read()))
    flat, names = enter(df, text=text)
    flat = flat.withColumn("text", F.col("text").cast("string"))
    source = "text"
    if text in names and dict(df.dtypes)[text] == "string":  # the column itself, so that it goes to tasks once
        flat, source = flat.drop("text"), f"in_{names.index(text)}"
    made = flat.drop("text").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = vocabulary.value.coders()
        for batch in batches:
            rest = batch.select([n for n in batch.schema.names if n != "text"])
            at, texts = 0, batch.column(source).cast(pa.binary())
            while at < len(texts):  # answers of some MB at a time
                flat_ids, ends, back, size, begin = [], [0], [], 0, at
                while at < len(texts) and size < 4 << 20:
                    raw = texts[at].as_py() or b""
                    ids = encoder.encode(raw.decode("utf-8", "replace"))
                    flat_ids += ids
                    ends.append(len(flat_ids))
                    back.append(decoder.decode(ids) if decode else None)
                    size += len(raw)
                    at += 1
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat_ids, pa.int32()))
                part = rest.slice(begin, at - begin)
                yield pa.RecordBatch.from_arrays([*part.columns, ids, pa.array(back, pa.string())], names=[*part.schema.names, "ids", "decoded"])

    out = {"ids": F.col("ids")} | ({"decoded": F.col("decoded")} if decode else {})
    return leave(flat.mapInArrow(work, made), names, out)
