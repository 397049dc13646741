"""Streaming byte-pair encoding and decoding with bounded lookahead.

The encoder is one machine over a text: it takes pieces of text, splits off
words, and gives out the tokens that are stable. Inside a word it reads symbols
from the left and keeps, for each place, the last token of the encoding up to
there; the token before which all places that can still matter agree is stable.
How far that can lie behind is a property of the merge list, its sufficient
lookahead, which is computed once and bounds the places that are held. So texts
and words of any length take constant memory. The decoder is a state machine
that takes tokens and gives out text whenever complete characters are known.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, raw, slices

#: Most words whose tokens a task remembers, and the longest such word.
WORD_MEMO, LONG_WORD = 250_000, 200
#: Most pairs of tokens of which a machine remembers whether they fit.
PAIRS = 200_000
#: Characters of a text that the machine takes at a time.
PIECE = 1 << 16
#: Symbols after which the machine of a word looks for stable tokens.
STRIDE = 16
#: Tokens that the decoder takes at a time.
DECODE_TOKENS = 16_384
#: Code points of white space that count as one space (fixed values).
SPACES = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"

#: Ranges whose letters stay one letter each in NFC and lower case and compose with no letter before them (fixed values).
INERT = (
    r"A-Za-z\u00c0-\u012f\u0131-\u024f\u0370-\u03ff\u0400-\u052f\u05d0-\u05ea\u0620-\u064a\u0904-\u0939\u0e01-\u0e30\u3041-\u3096"
    r"\u30a1-\u30fa\u3400-\u9fff\uac00-\ud7a3"
)
#: Contractions, letters, one number, other marks (fixed values).
WORDS = r"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{L}--[{new}]]+|[\p{N}--[{new}]]|(?:[^\s\p{L}\p{N}]|[{new}])+"
#: Ranges that later Unicode tables take for letters or numbers and the library does not (fixed values).
NEW_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F),
    (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6),
    (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191),
    (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
#: Lower-case forms that this Python does not know yet: first, last, distance (fixed values).
NEW_LOWER = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20),
    (0x16EA0, 0x16EB8, 0x1B),
)
LOWER = {c: c + d for a, b, d in NEW_LOWER for c in range(a, b + 1)}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return [chr(b) if b in plain else chr(256 + sum(x not in plain for x in range(b))) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[int, int, int]], lengths: list[int]) -> int:
    """Symbols beyond a token that can decide whether it appears.

    ``merges`` lists (left, right, product) by priority, ``lengths`` the symbols
    of each token. Whether a token still stands when a merge is tried depends
    on its right neighbour alone, and on that neighbour's own reach at that
    time; reaches are carried through the list in order of priority.
    """
    reach = [0] * len(lengths)
    for left, right, product in merges:
        ahead = lengths[right] + reach[right]
        reach[product] = max(reach[product], reach[right])
        reach[left] = max(reach[left], ahead)
    return max(reach, default=0)


def _spelled(token: int, parts: dict[int, tuple[int, int]]) -> list[int]:
    """The symbols of a token."""
    out, work = [], [token]
    while work:
        token = work.pop()
        if token in parts:
            work += reversed(parts[token])
        else:
            out.append(token)
    return out


class Vocabulary:
    """A ``tokenizers`` JSON file of kind byte-level BPE with a word-end suffix, as tables."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.text = [""] * size
        for token, k in (ids | self.special).items():
            self.text[k] = token
        if any(c.isspace() for t in self.special for c in t):
            raise ValueError("special tokens with white space are not supported")
        marks = byte_characters()
        self.inner = [ids.get(c, -1) for c in marks]
        self.final = [ids.get(c + self.suffix, -1) for c in marks]
        self.rank: dict[int, tuple[int, int]] = {}  # left * size + right: (priority, product)
        self.length = [1] * size
        merges = []
        for k, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, c = ids[left], ids[right], ids[left + right]
            self.rank.setdefault(a * size + b, (k, c))
            self.length[c] = self.length[a] + self.length[b]
            merges.append((a, b, c))
        self.lookahead = sufficient_lookahead(merges, self.length)
        self.longest = max(self.length)
        parts = {c: (a, b) for a, b, c in reversed(merges)}  # the first merge that makes each token
        #: Of a token, the merge that makes it in its own encoding: left, right and priority (-1: a symbol).
        self.made: list[tuple[int, int, int]] = [(-1, -1, -1)] * size
        self.endings: dict = {}  # symbols of tokens, read backwards; -1 leads to the token
        for token in {*self.inner, *self.final, *parts} - {-1}:
            symbols, last = _spelled(token, parts), []
            if self.merged(list(symbols), last) == [token]:
                if last:
                    self.made[token] = last[-1]
                node = self.endings
                for symbol in reversed(symbols):
                    node = node.setdefault(symbol, {})
                node[-1] = token
        value = {c: b for b, c in enumerate(marks)}
        self.bytes = [self._bytes(t, value) for t in self.text]
        self.names = [t.encode() for t in self.text]

        self._encoder: Encoder | None = None

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their symbols.

        They are if at no time the two tokens at the boundary merge before one
        of them merges with its other neighbour. The times are gone through
        backwards, by taking apart the token that was made last.
        """
        rank, made, size = self.rank, self.made, len(self.text)
        if left * size + right in rank:
            return False
        while True:
            a, b = made[left], made[right]
            if a[2] > b[2]:
                left = a[1]
                pair = rank.get(left * size + right)
                if pair and pair[0] < a[2]:
                    return False
            elif b[2] >= 0:
                right = b[0]
                pair = rank.get(left * size + right)
                if pair and pair[0] <= b[2]:  # among equals the leftmost merges first
                    return False
            else:
                return True

    def merged(self, symbols: list[int], done: list | None = None) -> list[int]:
        """The encoding of symbols by its definition: all merges by priority, leftmost first among equals; changes ``symbols``.

        ``done`` takes the merges in order: left, right, priority.
        """
        find, size, none = self.rank.get, len(self.text), (len(self.rank), -1)
        found = [find(a * size + b, none) for a, b in zip(symbols, symbols[1:])]
        while found:
            best = min(found)
            if best[1] < 0:
                break
            at = found.index(best)
            if done is not None:
                done.append((symbols[at], symbols[at + 1], best[0]))
            symbols[at : at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = find(symbols[at - 1] * size + best[1], none)
            if at < len(found):
                found[at] = find(best[1] * size + symbols[at + 1], none)
        return symbols

    def encoder(self) -> Encoder:
        """One encoder of this process, which keeps its memo from task to task."""
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder

    def _bytes(self, token: str, value: dict[str, int]) -> bytes:
        """What a token stands for: its bytes, and a space for a word's end."""
        if token in self.special:
            return token.encode()
        ends = bool(self.suffix) and token.endswith(self.suffix)
        return bytes(value[c] for c in (token[: -len(self.suffix)] if ends else token)) + b" " * ends


class WordMachine:
    """Tokens of one word from its symbols, given as soon as they are stable.

    A sequence of tokens is the encoding of its symbols if each two neighbours
    are each other's encoding, so the last token of the encoding up to a place
    is the one that spells its end and fits the last token before. The encoding
    of the whole word passes through one of the last ``longest`` places; what
    is common to the encodings up to all of these is stable.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        #: Tokens more symbols behind than this are stable.
        self.window = vocabulary.longest + vocabulary.lookahead
        self.pairs: dict[int, bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.symbols: list[int] = []  # those of the tokens that are not given out yet
        self.last: list[int] = [-1]  # last token of the encoding up to place k among them, and where it begins
        self.back: list[int] = [0]
        self.before = -1  # the last token given out

    def feed(self, symbols: Iterable[int]) -> list[int]:
        out: list[int] = []
        endings, fits, pairs, size = self.vocabulary.endings, self.vocabulary.fits, self.pairs, len(self.vocabulary.text)
        held, last, back, before = self.symbols, self.last, self.back, self.before
        for symbol in symbols:
            held.append(symbol)
            end = len(held)
            at, node, found = end - 1, endings.get(symbol), []
            while node is not None:
                token = node.get(-1)
                if token is not None:
                    found.append((token, at))
                at -= 1
                node = node.get(held[at]) if at >= 0 else None
            while len(found) > 1:  # the longest first; a symbol alone always stands if nothing longer does
                token, at = found[-1]
                left = last[at] if at else before
                if left < 0:
                    break
                good = pairs.get(left * size + token)
                if good is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    good = pairs[left * size + token] = fits(left, token)
                if good:
                    break
                found.pop()
            token, at = found[-1] if found else (symbol, end - 1)
            last.append(token)
            back.append(at)
            if end % STRIDE == 0:
                out += self._stable()
                held, last, back, before = self.symbols, self.last, self.back, self.before
        return out

    def _stable(self) -> list[int]:
        """Tokens common to the encodings up to all places through which the word's encoding can pass."""
        end = len(self.symbols)
        live = {*range(max(0, end - self.vocabulary.longest + 1), end + 1)}
        while len(live) > 1:
            most = max(live)
            live.remove(most)
            live.add(self.back[most])
        return self._given(live.pop())

    def _given(self, end: int) -> list[int]:
        """The tokens up to a place, which are forgotten here."""
        out, at = [], end
        while at:
            out.append(self.last[at])
            at = self.back[at]
        if end:
            self.before = out[0]
            self.symbols = self.symbols[end:]
            self.last = [-1, *self.last[end + 1 :]]
            self.back = [0, *(x - end for x in self.back[end + 1 :])]
        return out[::-1]

    def finish(self) -> list[int]:
        out, at, last, back = [], len(self.symbols), self.last, self.back
        while at:
            out.append(last[at])
            at = back[at]
        self._clear()
        return out[::-1]


class Encoder:
    """Ids of whole texts, as the tokenizers library gives them without special tokens added.

    Strings of special tokens in a text become their ids. The rest is brought
    to NFC, white space is folded, letters are lower-cased one by one, and words
    are split off. ``feed`` takes pieces of a text and gives the ids that are
    certain, as little-endian unsigned 32-bit integers; ``finish`` gives the
    rest. Words up to ``LONG_WORD`` characters are remembered with what the
    machine gave for them.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.machine, self.long = WordMachine(vocabulary), WordMachine(vocabulary)
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) or r"(?!)")
        self.special_ids = {t: np.array([k], "<u4").tobytes() for t, k in vocabulary.special.items()}
        self.spaces = regex.compile(SPACES)
        new = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in NEW_LETTERS)
        self.find = regex.compile(WORDS.replace("{new}", new)).findall
        self.find_latin = regex.compile(WORDS.replace("--[{new}]", "").replace("(?:[^\\s\\p{L}\\p{N}]|[{new}])", "[^\\s\\p{L}\\p{N}]")).findall
        self.later = regex.compile("[" + "".join(map(chr, LOWER)) + "]")
        self.memo = Memo(self._ids, WORD_MEMO)
        # Where a text can be cut so that its parts encode by themselves: before white space, which no word, special token
        # or composed character spans; before a digit, which is a word of its own; between letters that compose with
        # nothing. The run before the latter two is too long for a contraction or a special token to be cut.
        letters, most = rf"[\p{{L}}&&[{INERT}]]", max(map(len, vocabulary.special), default=0) + 4
        self.cuts = (
            (regex.compile(r"(?r)(?=[ \t\n\r])"), False),
            (regex.compile(rf"(?rV1)(?<=(?:{letters}|[0-9]){{{most}}})(?=[0-9](?:{letters}|[0-9]))"), False),
            (regex.compile(rf"(?rV1)(?<={letters}{{{most}}})(?={letters}{{2}})"), True),
        )
        self.held = ""  # text whose words are not yet certain
        self.open = False  # the held text continues the word that is in ``long``
        self.byte = b""  # last byte of that word, final or not

    def symbols(self, word: bytes, ends: bool) -> list[int]:
        """The id of each byte; bytes that the vocabulary lacks are left out."""
        inner = self.vocabulary.inner
        found = [*map(inner.__getitem__, word[:-1]), (self.vocabulary.final if ends else inner)[word[-1]]]
        return found if min(found) >= 0 else [x for x in found if x >= 0]

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _ids(self, word: str) -> bytes:
        machine = self.machine
        return self._packed(machine.feed(self.symbols(word.encode(), True)) + machine.finish())

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if not text.isascii():
            text = self.spaces.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ")
        text = text.lower()
        if text and max(text) < "\u0300":  # no character here that tables disagree on
            return self.find_latin(text)
        return self.find(self.later.sub(lambda m: m[0].translate(LOWER), text))

    def _encoded(self, text: str, continues: bool) -> list[bytes]:
        """Ids of a text whose first word continues the open one, if any; with ``continues`` its last word stays open."""
        out, at, memo = [], 0, self.memo
        for found in [*self.special.finditer(text), None] if "<" in text else [None]:
            words = self.words(text[at : found.start() if found else None])
            if self.open:
                out.append(self._long(words.pop(0), continues and not found and not words))
            last = words.pop() if continues and not found and words else None
            for word in words:
                out.append(memo[word] if len(word) <= LONG_WORD else self._long(word, False))
            if last is not None:
                out.append(self._long(last, True))
            if found:
                out.append(self.special_ids[found[0]])
                at = found.end()
        return out

    def _long(self, part: str, continues: bool) -> bytes:
        """Ids of a part of a word, through the machine that is not remembered; its last byte waits until it is known to be the last."""
        data = self.byte + part.encode()
        self.open, self.byte = continues, data[-1:] if continues else b""
        out = self.long.feed(self.symbols(data[:-1], False)) if len(data) > 1 else []
        if not continues:
            out += self.long.feed(self.symbols(data[-1:], True)) + self.long.finish()
        return self._packed(out)

    def feed(self, text: str) -> bytes:
        out = []
        for at in range(0, len(text), PIECE):
            self.held += text[at : at + PIECE]
            if len(self.held) < PIECE:
                continue
            cut, inside = self._cut()
            if cut:
                part, self.held = self.held[:cut], self.held[cut:]
                out += self._encoded(part, inside)
        return b"".join(out)

    def _cut(self) -> tuple[int, bool]:
        """The last place in the second half of the held text where it can be cut (else 0), and whether that is inside a word.

        Only runs of marks and of letters that may compose are held whole.
        """
        half = len(self.held) // 2
        for pattern, inside in self.cuts:
            found = pattern.search(self.held, half)
            if found:
                return found.start(), inside
        return 0, False

    def finish(self) -> bytes:
        part, self.held = self.held, ""
        return b"".join(self._encoded(part, False))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        return self.feed(text) + self.finish()


class Decoder:
    """An incremental machine from tokens to text, in constant memory.

    ``table`` gives the bytes of each token, ``between`` stands between tokens.
    Bytes of an unfinished character are held until later tokens complete it;
    bytes that can be no character become U+FFFD.
    """

    def __init__(self, table: list[bytes], between: bytes = b""):
        self.table, self.between = table, between
        self.held, self.begun = b"", False

    def feed(self, tokens: list[int]) -> str:
        """The text that is certain after some more tokens."""
        if not tokens:
            return ""
        data = self.between.join(map(self.table.__getitem__, tokens))
        data = self.held + (self.between + data if self.begun else data)
        self.begun = True
        cut = len(data)
        for back in range(1, min(4, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:
                need = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
                cut = len(data) - back if need > back else len(data)
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held, self.begun = self.held.decode("utf-8", "replace"), b"", False
        return rest


def _decoded(machine: Decoder, ids: bytes) -> Iterator[str]:
    for at in range(0, len(ids), 4 * DECODE_TOKENS):
        yield machine.feed(np.frombuffer(ids[at : at + 4 * DECODE_TOKENS], "<u4").tolist())
    yield machine.finish()


def decode_text(vocabulary: Vocabulary, ids: bytes) -> str:
    """The text that ids stand for: words in lower case, a space after each word."""
    return "".join(_decoded(Decoder(vocabulary.bytes), ids))


def decode_tokens(vocabulary: Vocabulary, ids: bytes) -> Iterator[str]:
    """Pieces of what the library gives for a file that names no decoder: token strings joined by spaces."""
    return _decoded(Decoder(vocabulary.names, b" "), ids)


def _streamed(encoder: Encoder, vocabulary: Vocabulary, text: str, decoded: bool, kept: bool) -> tuple[bytes | None, int, str, str | None]:
    """Ids (if ``kept``), their number, and digests of ids and decoded text; the ids are used piece by piece as they come."""
    ids, plain, machine, count, parts = hashlib.sha256(), hashlib.sha256(), Decoder(vocabulary.names, b" "), 0, []
    for at in range(0, len(text) + PIECE, PIECE):
        piece = encoder.feed(text[at : at + PIECE]) if at < len(text) else encoder.finish()
        ids.update(piece)
        count += len(piece) // 4
        if kept:
            parts.append(piece)
        if decoded:
            for part in range(0, len(piece), 4 * DECODE_TOKENS):
                plain.update(machine.feed(np.frombuffer(piece[part : part + 4 * DECODE_TOKENS], "<u4").tolist()).encode())
    plain.update(machine.finish().encode())
    return b"".join(parts) if kept else None, count, ids.hexdigest(), plain.hexdigest() if decoded else None


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True, ids: bool = True
) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) for every row.

    ``path`` names the vocabulary file on the driver; its tables are broadcast
    (their size is the file's, not the data's). Null and empty texts have no
    ids. ``ids`` holds little-endian unsigned 32-bit integers. Without
    ``decoded`` that digest is null; without ``ids`` those are null and a text's
    ids are hashed and decoded as they come, in constant memory. Repeated rows
    are all returned, null ids stay null, other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        encoder = vocabulary.encoder()
        for batch in slices(batches):
            found = [_streamed(encoder, vocabulary, t.decode("utf-8", "replace"), decoded, ids) for t in raw(batch.column(1))]
            kinds = (pa.binary(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)]
            yield pa.record_batch([batch.column(0), *columns], ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string")
