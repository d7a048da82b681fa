"""BPE encoding and decoding as streams with bounded memory.

Encoding. A text comes in pieces; ``Words`` cuts it into words as soon as no later character
can change the cut, and ``Transducer`` turns a word's bytes into ids as soon as no later byte
can change them. How many bytes that takes follows from the merge list, see ``lookahead``.
Words shorter than the window are merged at once and remembered.

Decoding. Ids become bytes, and an incremental UTF-8 machine turns bytes into text; an
unfinished character waits for its next byte, a broken one becomes U+FFFD.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from shelflens.llm.bpe import Vocabulary, shared_file, vocabulary

#: Characters that are taken in at a time.
PIECE = 1 << 16
#: A word is merged at once up to this many characters, beyond that in a stream.
WINDOW = 512
#: Words that a worker remembers; it starts anew beyond that.
REMEMBERED = 250_000


def lookahead(vocab: Vocabulary) -> int:
    """Bytes after a token's end that decide whether it stands.

    Compare the merging of two byte strings with a common beginning, merge rank by merge rank.
    They agree up to some boundary, at first the end of the common part. A merge (a, b) can
    move it only when a is the token left of the boundary and b, in one of the two, the token
    right of it; then it moves left by the length of a, and at a later merge (a', b') that
    moves it again, b' starts with a. So the boundary moves at most by the longest chain of
    merges of rising rank in which each left part is a prefix of the next right part, counted
    in bytes of the left parts. This needs a merge list in which each part of a merge is a
    byte or was made before, and each merge makes a new token.
    """
    text, known, best, most = vocab.text_of, set(vocab.byte_ids), {}, 0
    for (a, b), new in zip(vocab.pairs, vocab.made, strict=True):
        if a not in known or b not in known or new in known:
            raise ValueError("merges must use what was made before and make something new")
        known.add(new)
        right = text[b]
        reach = len(text[a]) + max(best.get(right[:n], 0) for n in range(1, len(right) + 1))
        best[text[a]] = max(best.get(text[a], 0), reach)
        most = max(most, reach)
    return most


def merged(ids: list[int], vocab: Vocabulary) -> list[int]:
    """All merges of a short list of ids: the pair of lowest rank, leftmost first."""
    find, size, made = vocab.rank.get, vocab.size, vocab.made
    none = len(made)
    ranks = [find(a * size + b, none) for a, b in zip(ids, ids[1:], strict=False)]
    while ranks and (r := min(ranks)) < none:
        i = ranks.index(r)
        ids[i : i + 2] = [made[r]]
        del ranks[i]
        if i < len(ranks):
            ranks[i] = find(ids[i] * size + ids[i + 1], none)
        if i:
            ranks[i - 1] = find(ids[i - 1] * size + ids[i], none)
    return ids


class Transducer:
    """The bytes of one word in, ids out; holds at most ``lookahead`` plus one block of bytes."""

    def __init__(self, vocab: Vocabulary, ahead: int, block: int = WINDOW):
        self.vocab, self.ahead, self.block, self.held = vocab, ahead, block, []

    def feed(self, symbols: list[int]) -> Iterator[int]:
        for at in range(0, len(symbols), self.block):
            self.held += symbols[at : at + self.block]
            if len(self.held) > self.ahead + self.block:
                stable, end = len(self.held) - self.ahead, 0
                for token in merged(self.held.copy(), self.vocab):
                    if end + (n := len(self.vocab.text_of[token])) > stable:
                        break
                    end += n
                    yield token
                del self.held[:end]

    def finish(self) -> list[int]:
        rest, self.held = merged(self.held, self.vocab), []
        return rest


class Words:
    """Characters in, words out. ``feed`` and ``finish`` give lists of (characters, ends).

    A word longer than the window comes in parts, the last of which ends it. Held back is what
    later characters could still change: at most the window and three characters.
    """

    KINDS = [regex.compile(k) for k in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")]

    def __init__(self, vocab: Vocabulary):
        self.words, self.held, self.kind = vocab.words, "", None

    def feed(self, piece: str) -> list[tuple[str, bool]]:
        found = []
        self.held += piece
        if self.kind is not None and not self._go_on(found):
            return found
        at, end = 0, len(self.held)
        spans = [m.span() for m in self.words.finditer(self.held)]
        # The last word can grow, and an apostrophe before it can take one or two letters in.
        while spans and end - spans[-1][0] <= 3:
            spans.pop()
        if spans:
            at = spans.pop()[0]
        found += [(self.held[a:b], True) for a, b in spans]
        self.held = self.held[at:]
        if len(self.held) > WINDOW:
            start = self.held[0] == " " and not self.held[1].isspace()
            self.kind = next(k for k in self.KINDS if k.match(self.held, start))
            self._go_on(found, start)
        return found

    def _go_on(self, found: list[tuple[str, bool]], start: int = 0) -> bool:
        """Hand on what belongs to the long word; whether it has ended."""
        run = self.kind.match(self.held, start)
        end = run.end() if run else start
        if end == len(self.held) or self.kind is self.KINDS[3]:
            # A run of space leaves its last character to what follows, if anything does.
            cut = max(0, end - 1)
        else:
            cut = end
        over = end < len(self.held)
        if cut or over:
            found.append((self.held[:cut], over))
        self.held = self.held[cut:]
        if over:
            self.kind = None
        return over

    def finish(self) -> list[tuple[str, bool]]:
        rest, kind = self.held, self.kind
        self.held, self.kind = "", None
        if kind is not None:
            return [(rest, True)]
        return [(w, True) for w in self.words.findall(rest)]


class Coder(dict):
    """Remembers words as (ids joined by commas, the ids' bytes)."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.ahead = vocab, lookahead(vocab)

    def __missing__(self, word: str) -> tuple[str, bytes]:
        found = self[word] = self.known(merged(self.vocab.ids(word), self.vocab))
        return found

    def known(self, ids: list[int]) -> tuple[str, bytes]:
        text = self.vocab.text_of
        return ",".join(map(str, ids)), b"".join([text[i] for i in ids])

    def encode(self, pieces: Iterable[str]) -> Iterator[list[tuple[str, bytes]]]:
        """Stretches of coded words, in order, while the text comes in."""
        words, long = Words(self.vocab), None

        def coded(found: list[tuple[str, bool]]) -> Iterator[list[tuple[str, bytes]]]:
            nonlocal long
            plain = []
            for word, ends in found:
                if ends and long is None and len(word) <= 2 * WINDOW:
                    plain.append(self[word])
                    continue
                long = long or Transducer(self.vocab, self.ahead)
                ids = list(long.feed(self.vocab.ids(word)))
                if ends:
                    ids += long.finish()
                    long = None
                if ids:
                    plain.append(self.known(ids))
            yield plain

        for piece in pieces:
            yield from coded(words.feed(piece))
        yield from coded(words.finish())


def pieces_of(text: str) -> Iterator[str]:
    return (text[at : at + PIECE] for at in range(0, len(text), PIECE))


def stretches(coder: Coder, text: str) -> Iterator[list[tuple[str, bytes]]]:
    """A whole text in coded stretches; special strings are one id each."""
    for part, special in coder.vocab.parts(text):
        if special:
            yield [coder.known([coder.vocab.special[part]])]
        elif len(part) <= PIECE:
            # One piece: nothing follows that could change a cut.
            found = coder.vocab.words.findall(part)
            if len(part) > WINDOW and max(map(len, found)) > WINDOW:
                yield from coder.encode([part])
            else:
                yield list(map(coder.__getitem__, found))
        else:
            yield from coder.encode(pieces_of(part))


def encode(vocab: Vocabulary, text: str) -> list[int]:
    """All ids of a text, for callers that want a list."""
    coder = Coder(vocab)
    return [int(i) for s in stretches(coder, text) for ids, _ in s for i in ids.split(",")]


class Decoder:
    """Ids in, text out, byte by byte: an unfinished character waits in the machine."""

    def __init__(self, vocab: Vocabulary):
        self.text_of, self.machine = vocab.text_of, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join([self.text_of[i] for i in ids]))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


_coders: dict[bytes, Coder] = {}


def coder_for(content: bytes) -> Coder:
    if content not in _coders:
        _coders.clear()
        _coders[content] = Coder(vocabulary(content))
    return _coders[content]


def digests(coder: Coder, text: str) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids and of the decoded text, in one pass."""
    ids_sum, text_sum = hashlib.sha256(), hashlib.sha256()
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    count = 0
    for stretch in stretches(coder, text):
        if stretch:
            ids = ",".join([s for s, _ in stretch])
            ids_sum.update(("," + ids if count else ids).encode())
            count += ids.count(",") + 1
            text_sum.update(machine.decode(b"".join([b for _, b in stretch])).encode())
    text_sum.update(machine.decode(b"", True).encode())
    return count, ids_sum.hexdigest(), text_sum.hexdigest()


def round_trip(
    docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Ids are those of the tokenizers library without added special tokens (special strings in
    a text are one id), decoding is its ``decode`` with special tokens kept. A null text
    counts as empty: no ids, empty decoded text. Rows that repeat are coded each; other
    columns are ignored; an empty table gives no rows. No shuffle.
    """
    file = shared_file(docs.sparkSession, vocabulary_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(file.value)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                rows.append(digests(coder, value.as_py() or ""))
                if len(coder) > REMEMBERED:
                    coder.clear()
            counts, ids, texts = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType(
        [
            rows.schema["doc_id"],
            StructField("n_tokens", LongType()),
            StructField("ids_sha256", StringType()),
            StructField("decoded_sha256", StringType()),
        ]
    )
    return rows.mapInArrow(run, schema)


def encoded(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its ids themselves: ``doc_id, ids``; null and empty texts have none."""
    file = shared_file(docs.sparkSession, vocabulary_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(file.value)
        for batch in batches:
            for i, value in enumerate(batch.column(1)):
                ids = [int(x) for s in stretches(coder, value.as_py() or "") for w, _ in s for x in w.split(",")]
                if len(coder) > REMEMBERED:
                    coder.clear()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([ids], pa.list_(pa.int32()))], ["doc_id", "ids"]
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, StructType([rows.schema["doc_id"], StructField("ids", ArrayType(IntegerType()))]))


def decoded(coded: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per list of ids with its text: ``doc_id, text``; a null list gives an empty text."""
    file = shared_file(coded.sparkSession, vocabulary_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(file.value)
        for batch in batches:
            texts = []
            for value in batch.column(1):
                decoder = Decoder(vocab)
                texts.append(decoder.feed(value.as_py() or []) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = coded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, StructType([rows.schema["doc_id"], StructField("text", StringType())]))
