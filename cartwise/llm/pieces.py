"""SentencePiece encoding and decoding by a merge-type prefix table.

The encoding of every prefix of a text ends in exactly one token.  The table
holds that token for every prefix: the vocabulary's automaton lists the tokens
that end at a place, longest first, and the one that is compatible with the last
token of the prefix before it is the entry.  Two tokens are compatible if merging
the characters of both, best score first, yields just these two; a sequence whose
neighbours are all compatible is what merging yields, and there is only one.  The
ids are recovered from the table backwards.  Compatibility of a pair is worked out
once and remembered (a bounded number of pairs).

Texts are cut where no piece of the vocabulary can reach across: before a space
that follows another character, and around characters that are in no piece.
Encodings of such parts are remembered per task (a bounded number of them).

Characters in no piece become byte pieces; a space is the mark U+2581 and a mark
precedes every text that is not empty, as the model file says.  Decoding turns
marks into spaces, drops the one in front, and reads runs of byte pieces as UTF-8
with U+FFFD for each byte that is none.

Defined results: null text is empty and has no ids; texts of any length are
encoded whole; repeated rows are encoded each for itself; an empty table gives no
rows; other columns are kept, and columns added here replace their namesakes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.common import table

SPACE = "▁"
CACHE_PARTS = 200_000   # in each of two generations
LONGEST = 48            # characters of a part that is remembered; longer ones seldom recur
PART_ROOM = 24          # and characters of parts and their ids, a part, that a generation holds
CACHE_PAIRS = 500_000


class Vocabulary:
    """Pieces, scores and special ids of a model file (read on the driver)."""

    def __init__(self, pieces: list[str], scores: list[float], normal: list[bool],
                 byte_ids: list[int], unknown: int):
        self.pieces, self.scores, self.normal = pieces, scores, normal
        self.byte_ids, self.unknown = byte_ids, unknown
        text = "\n".join(f"{p} {s}" for p, s in zip(pieces, scores))
        self.name = hashlib.md5(text.encode()).hexdigest()

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(m.vocab_size())
        pieces = [m.id_to_piece(i) for i in ids]
        special = [m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i) for i in ids]
        named = {m.id_to_piece(i): i for i in ids if m.is_byte(i)}
        return cls(pieces, [m.get_score(i) for i in ids], [not s for s in special],
                   [named.get(f"<0x{b:02X}>", -1) for b in range(256)], m.unk_id())


class Encoder:
    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.score = {p: s for p, s, ok in zip(vocab.pieces, vocab.scores, vocab.normal) if ok}
        self.id = {p: i for i, (p, ok) in enumerate(zip(vocab.pieces, vocab.normal)) if ok}
        self.alphabet = {c for p in self.id for c in p}
        self.byte_of = {i: b for b, i in enumerate(vocab.byte_ids) if i >= 0}
        # tokens of the table: pieces that merging can make, and single characters
        self.tokens = sorted({p for p in self.id if len(p) > 1 and self.merged(p) == [p]}
                             | self.alphabet)
        self.ids = [self.id.get(t, -1) for t in self.tokens]
        self.sizes = [len(t) for t in self.tokens]
        self.automaton = ahocorasick.Automaton()
        for k, t in enumerate(self.tokens):
            self.automaton.add_word(t, (k, len(t)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.odd: set[str] = set()
        self.limit = CACHE_PARTS
        self.room = 0       # characters held by the newer generation
        self.unsure = False  # the text in hand has an odd part that is not remembered
        self.last_special = max([i for i, ok in enumerate(vocab.normal) if not ok], default=-1)
        crossing = any(SPACE in p[1:] and p.strip(SPACE) for p in self.id)
        outside = "".join(c for c in "\n\t\r" if c not in self.alphabet)
        plain = f"[^{SPACE}{outside}]"
        # parts that no piece reaches across
        self.cut = (re.compile(f"[^{outside}]+|[{outside}]" if outside else r"(?s).+") if crossing
                    else re.compile(f"{SPACE}*{plain}+|{SPACE}+" + (f"|[{outside}]" if outside else "")))

    def merged(self, text: str) -> list[str]:
        """Pieces left after merging neighbours, best score (then leftmost) first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            x, y = self.tokens[a], self.tokens[b]
            found = self.pairs[key] = self.merged(x + y) == [x, y]
        return found

    def table(self, text: str) -> list[int]:
        """Last token of the encoding of each prefix of ``text`` (known characters)."""
        last = [-1] * (len(text) + 1)
        pairs, compatible = self.pairs, self.compatible
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                start = end - size
                if start == 0:
                    last[end] = token
                elif (before := last[start]) >= 0:
                    hit = pairs.get(before << 32 | token)
                    if hit or hit is None and compatible(before, token):
                        last[end] = token
        return last

    def _known_ids(self, text: str) -> list[int]:
        """Ids of a text of known characters, from its table backwards."""
        last, end, found = self.table(text), len(text), []
        ids, sizes = self.ids, self.sizes
        while end > 0:
            token = last[end]
            found.append(token)
            end -= sizes[token]
        out = []
        for token in reversed(found):
            i = ids[token]
            if i < 0:
                out += self._bytes(self.tokens[token])
            else:
                out.append(i)
        return out

    def encode_part(self, text: str) -> list[int]:
        """Ids of a part of which only known characters merge."""
        if self.alphabet.issuperset(text):
            return self._known_ids(text)
        out: list[int] = []
        at = 0
        while at < len(text):
            stop = at
            while stop < len(text) and text[stop] in self.alphabet:
                stop += 1
            if stop > at:
                out += self._known_ids(text[at:stop])
                at = stop
            else:
                out += self._bytes(text[at])
                at += 1
        return out

    def _bytes(self, text: str) -> list[int]:
        ids = [self.vocab.byte_ids[b] for b in text.encode()]
        return ids if min(ids) >= 0 else [self.vocab.unknown]

    def encoded(self, text: str) -> tuple[str, str]:
        """Ids of ``text`` joined by commas, and the text that they decode to."""
        if not text:
            return "", ""
        marked = SPACE + text.replace(" ", SPACE)
        parts = self.cut.findall(marked)
        known = self.known
        self.unsure = False
        try:
            ids = [known[p] for p in parts]
        except KeyError:
            ids = [known.get(p) or self._remember(p) for p in parts]
        if self.unsure or self.odd and not self.odd.isdisjoint(parts):
            return ",".join(ids), self.decode(list(map(int, ",".join(ids).split(","))))
        # the pieces of every part spell the part
        return ",".join(ids), marked[1:].replace(SPACE, " ")

    def _remember(self, part: str) -> str:
        """A part's ids, remembered in the newer of two generations: a full one
        becomes the older, and parts still in use move to the newer again.  Long
        parts are encoded each time: memory is bounded in characters, not only in
        parts.  Parts whose ids do not decode to the part are noted as odd."""
        entry = self.known.get(part) or self.older.get(part)
        if entry is None:
            ids = self.encode_part(part)
            entry = ",".join(map(str, ids))
            odd = min(ids) <= self.last_special and self.surface(ids) != part.replace(SPACE, " ")
            if len(part) > LONGEST:
                self.unsure |= odd
                return entry
            if odd:
                if len(self.odd) >= CACHE_PARTS:
                    self.odd.clear()
                    self.known.clear()
                    self.older.clear()
                    self.room, self.unsure = 0, True  # odd parts of this text are forgotten
                self.odd.add(part)
        if len(self.known) >= self.limit or self.room >= PART_ROOM * self.limit:
            self.older = dict(self.known)
            self.known.clear()
            self.room = 0
        self.known[part] = entry
        self.room += len(part) + len(entry)
        return entry

    def surface(self, ids: list[int]) -> str:
        """Text of ids, the mark in front kept as a space."""
        out, run = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if i == self.vocab.unknown:
                out.append(" ⁇ ")
            elif self.vocab.normal[i]:  # control ids have no text
                out.append(self.vocab.pieces[i].replace(SPACE, " "))
        if run:
            out.append(_utf8(bytes(run)))
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encoded(text)[0].split(","))) if text else []

    def decode(self, ids: list[int]) -> str:
        text = self.surface(ids)
        # the first id that has a text (control ids have none)
        first = next((i for i in ids if self.vocab.normal[i] or i in self.byte_of
                      or i == self.vocab.unknown), None)
        front = first is not None and self.vocab.normal[first] and self.vocab.pieces[first][:1] == SPACE
        return text[1:] if front else text


def _utf8(data: bytes) -> str:
    """UTF-8, with U+FFFD for each byte that starts no character."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[:e.start].decode() + "�")
            data = data[e.start + 1:]
    return "".join(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder_for(vocab: Vocabulary) -> Encoder:
    """One encoder per worker process and vocabulary: tasks share its memory."""
    if vocab.name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocab.name] = Encoder(vocab)
    return _ENCODERS[vocab.name]


OUTPUTS = {"n_tokens": "long", "ids": "array<int>", "ids_text": "string", "decoded": "string"}
_ARROW = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_text": pa.string(),
          "decoded": pa.string()}


def _encoding(vocab, hidden: str, own: list[str], outputs: list[str], remembered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(vocab.value)
        encoder.limit = remembered
        make = {
            "n_tokens": lambda ids, text: ids.count(",") + 1 if ids else 0,
            "ids": lambda ids, text: list(map(int, ids.split(","))) if ids else [],
            "ids_text": lambda ids, text: ids,
            "decoded": lambda ids, text: text,
        }
        for whole in batches:
            for at in range(0, whole.num_rows, 250):  # ids take more room than text
                batch = whole.slice(at, 250)
                names = batch.schema.names
                rows = {o: [] for o in outputs}
                for text in batch.column(names.index(hidden)):
                    ids, decoded = encoder.encoded(text.as_py() or "")
                    for o in outputs:
                        rows[o].append(make[o](ids, decoded))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(names.index(c)) for c in own],
                     *[pa.array(rows[o], _ARROW[o]) for o in outputs]], names=[*own, *outputs])

    return run


def encode(docs: DataFrame, model_path: str, text_col: str = "text",
           outputs=("n_tokens", "ids"), remembered: int | None = None) -> DataFrame:
    """``docs`` with the asked outputs: n_tokens, ids, ids_text (ids joined by
    commas) and decoded (the text that the ids decode to).  ``remembered``: parts
    whose encoding a worker keeps, in each of two generations (memory for speed)."""
    outputs = list(outputs)
    own = [c for c in docs.columns if c not in outputs]
    hidden = "__piece_text"
    vocab = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))  # one vocabulary
    schema = T.StructType([*docs.select(*own).schema.fields, *[
        f for o in outputs for f in T._parse_datatype_string(f"{o} {OUTPUTS[o]}").fields]])
    return (docs.select(*own, F.col(text_col).alias(hidden))
            .mapInArrow(_encoding(vocab, hidden, own, outputs, remembered or CACHE_PARTS), schema))


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with decoded: the text of an array of ids; null ids are none."""
    own = [c for c in rows.columns if c != "decoded"]
    hidden = "__piece_ids"
    vocab = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))
    schema = T.StructType([*rows.select(*own).schema.fields,
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(vocab.value)
        for batch in batches:
            names = batch.schema.names
            texts = [encoder.decode(ids.as_py() or []) for ids in batch.column(names.index(hidden))]
            yield pa.RecordBatch.from_arrays([*[batch.column(names.index(c)) for c in own],
                                              pa.array(texts, pa.string())], names=[*own, "decoded"])

    return rows.select(*own, F.col(ids_col).alias(hidden)).mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_pieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = encode(docs, default_model(), outputs=("n_tokens", "ids_text", "decoded"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
