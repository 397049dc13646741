"""Personal data in texts: exact patterns, and a conditional random field over word shapes.

The patterns find e-mail and network addresses, card and international phone
numbers. The field is fitted on a small labelled table (``pii_examples``, or the
caller's) and labels every word of every text by Viterbi in numpy batches. It
adds what patterns cannot tell: names, postal addresses and dates of birth by
their context, and e-mail addresses, phone numbers and network addresses in
forms that the patterns miss.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, hash_sample, raw, slices
from .crf import Crf, fit
from .pii_examples import labelled_examples
from .secret_scan import code_points

#: Kinds of the exact patterns, then those that the field alone finds. Label k + 1 of the field is kind k.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "name", "address", "birth")
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
#: Different labelled texts that the field is fitted on, at most about: those with the least hashes.
TRAIN_TEXTS = 5_000
#: Words that the field scores together, and places of a batch of runs in its decoder.
BLOCK, CELLS = 1 << 16, 1 << 19

_LOCAL_BYTES = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits: what fails from the run's start fails from its middle.
_IP = re.compile(rb"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(rb"[0-9]")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LINE_END = re.compile(rb"[\r\n]")


def luhn(digits: bytes) -> bool:
    total = 0
    for k, byte in enumerate(reversed(digits)):
        x = byte - 48
        total += (2 * x - 9 if x > 4 else 2 * x) if k & 1 else x
    return total % 10 == 0


def _digits(data: bytes) -> bytes:
    return bytes(b for b in data if 48 <= b <= 57)


def emails(data: bytes) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping, in time linear in the text."""
    free, at = 0, data.find(b"@")
    while at >= 0:
        start = at
        while start > free and data[start - 1] in _LOCAL_BYTES:
            start -= 1
        found = _DOMAIN.match(data, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        else:
            free = max(free, at + 1)
        at = data.find(b"@", max(at + 1, free))


def base_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in bytes, by kind and start; each kind leftmost and non-overlapping."""
    found = [(0, a, b) for a, b in emails(data)] if b"@" in data else []
    if _DIGIT.search(data):
        found += [(1, *m.span()) for m in _IP.finditer(data) if all(len(g.lstrip(b"0")) < 4 and int(g) < 256 for g in m.groups())]
        for m in _CARD.finditer(data):
            if m.end() - m.start() >= 13:
                digits = _digits(m[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, *m.span()))
        if b"+" in data:
            found += [(3, *m.span()) for m in _PHONE.finditer(data) if 9 <= len(_digits(m[0])) <= 15]
    return found


#: Buckets of a word's own features, and of those that it lends to one neighbour.
OWN, NEAR = 1 << 12, 1 << 11
#: Places of the neighbours that a word's label depends on.
AROUND = (-2, -1, 1, 2)
FEATURES = OWN + len(AROUND) * NEAR
#: A word, or the last four bytes of words, is known by itself if the labelled table holds it so often.
KNOWN = 8
_MARKS = b".,;:!?\"'()[]<>"
_TRIM = ".,;:!?\"'<>[](){}|#*$%&"


_CLASSES = bytes(0x58 if 65 <= b <= 90 else 0x78 if 97 <= b <= 122 else 0x64 if 48 <= b <= 57 else 0x75 if b > 127 else b for b in range(256))
_ALIKE, _REPEAT = re.compile(rb"(.)\1{4,}", re.S), re.compile(rb"(.)\1+", re.S)


def shape(word: bytes) -> bytes:
    """Classes of a word's characters: X, x, d, u for bytes beyond ASCII, others as they are; no more than four alike in a row."""
    return _ALIKE.sub(rb"\1\1\1\1", word.translate(_CLASSES))


def _short(value: bytes) -> bytes:
    """A long shape stands by its digest, so that looks of very long words stay small."""
    return value if len(value) <= 60 else hashlib.blake2b(value, digest_size=16).digest()


def _bucket(mark: bytes, value: bytes, most: int) -> int:
    return zlib.crc32(mark + value) % most


def look(word: bytes, known: frozenset[bytes]) -> tuple[bytes, ...]:
    """What the field sees of a word: shape, shape without repetitions, the word if it is known, its ending if that is known, digits, opening and closing mark."""
    plain = word.strip(_MARKS).lower()
    end = b"-" + plain[-4:]
    digits = b"%d" % min(len(_digits(word)), 20) if _DIGIT.search(word) else b"0"
    full = shape(word)
    return (
        _short(full), _short(_REPEAT.sub(rb"\1", full)), plain if plain in known else b"", end if end in known else b"", digits, word[:1] if word[:1] in b"([+" else b"",
        word[-1:] if word[-1:] in b".,;:" else b"",
    )


@lru_cache(maxsize=4_096)
def look_features(seen: tuple[bytes, ...] | None) -> tuple[list[int], list[int]]:
    """The features of a look for the word itself, and those that it lends to its neighbours; None stands for a text's end."""
    if seen is None:
        return [_bucket(b"end", b"", OWN)], [_bucket(b"end", b"", NEAR)]
    full, short, itself, end, digits, opening, closing = seen
    own = [(b"f", full), (b"c", short), (b"e", end), (b"d", digits), (b"p", opening), (b"q", closing), (b"w", itself)]
    lent = [(b"c", short), (b"q", closing), (b"w", itself)]
    return [_bucket(m, v, OWN) for m, v in own], [_bucket(m, v, NEAR) for m, v in lent]


def features(words: list[bytes | None], known: frozenset[bytes]) -> list[list[int]]:
    """Feature ids of each word in its place."""
    each = [look_features(None if w is None else look(w, known)) for w in words]
    out = []
    for k, (own, _) in enumerate(each):
        ids = list(own)
        for role, away in enumerate(AROUND):
            if 0 <= k + away < len(each):
                ids += [OWN + role * NEAR + f for f in each[k + away][1]]
        out.append(ids)
    return out


def labels(words: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """Label of each word: 1 + kind of the first span that overlaps it."""
    return [next((k + 1 for k, a, b in spans if a < end and start < b), 0) for start, end in words]


class Usual:
    """What the labelled spans of one kind have in common: numbers of words, digits, words said twice in a row."""

    def __init__(self, spans: list[bytes]):
        sizes = [len(s.split()) for s in spans]
        self.least, self.most = min(sizes, default=0), max(sizes, default=0)
        held = [_DIGIT.search(s) is not None for s in spans]
        self.all_digits, self.some_digits = all(held), any(held)
        self.echo = any(map(_echoes, spans))

    def allows(self, span: bytes) -> bool:
        """Whether a span is not unlike all labelled ones: no fewer words, at most twice as many."""
        digit = _DIGIT.search(span) is not None
        if not self.least <= len(span.split()) <= 2 * self.most:
            return False
        return (self.some_digits if digit else not self.all_digits) and (self.echo or not _echoes(span))


def _echoes(span: bytes) -> bool:
    """Whether a word without digits stands twice in a row."""
    words = [w.strip(_MARKS) for w in span.split()]
    return any(a == b and not _DIGIT.search(a) for a, b in zip(words, words[1:]))


class Field:
    """A fitted random field: its weights, the words that it knows by themselves, and what each kind's labelled spans have in common."""

    def __init__(self, model: Crf, known: frozenset[bytes], usual: list[Usual]):
        self.model, self.known, self.usual = model, known, usual

    def allows(self, kind: int, span: bytes) -> bool:
        if not self.usual[kind].allows(span):
            return False
        digits = _digits(span)
        return KINDS[kind] != "card" or (13 <= len(digits) <= 19 and luhn(digits))


def fit_field(rows: list[tuple[str, list[tuple[str, int, int]]]]) -> Field:
    """The field of labelled texts (text, [(kind, start, end)]), offsets in code points; none give one that labels nothing."""
    texts, counts = [], Counter()
    for text, spans in rows:
        data = text.encode()
        cut = [len(text[:x].encode()) for _, a, b in spans for x in (a, b)]
        places = [m.span() for m in _WORD.finditer(data)]
        marked = [(KINDS.index(k), a, b) for (k, *_), a, b in zip(spans, cut[::2], cut[1::2])]
        texts.append((data, places, marked))
        plain = [data[a:b].strip(_MARKS).lower() for a, b in places]
        counts.update(plain + [b"-" + w[-4:] for w in plain])
    known = frozenset(w for w, n in counts.items() if n >= KNOWN and len(w) > 1)
    sequences = [
        (features([None, *(d[a:b] for a, b in places), None], known), [0, *labels(places, marked), 0]) for d, places, marked in texts
    ]
    model = fit(sequences, FEATURES, 1 + len(KINDS))
    if not rows:
        model.emit[:, 0] = 1
    labelled: list[list[bytes]] = [[] for _ in KINDS]
    for data, _, marked in texts:
        for k, a, b in marked:
            labelled[k].append(data[a:b])
    return Field(model, known, [Usual(spans) for spans in labelled])


@lru_cache(maxsize=1)
def default_field() -> Field:
    """The field of the labelled table of this package; fitted once in a process."""
    return fit_field(labelled_examples())


def field_of(labelled: DataFrame, most: int = TRAIN_TEXTS) -> Field:
    """The field of a table (text, spans: array of structs kind, start, end); equal rows count once, rows with nulls are left out."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), "spans").where("text is not null and spans is not null").distinct()
    picked = hash_sample(rows, most, F.col("text"), F.col("spans")).collect()
    return fit_field([(r.text, [(s["kind"], s["start"], s["end"]) for s in r.spans]) for r in picked])


class _Looks(dict):
    """Numbers of different looks; row k of ``rows`` has what look k adds to the scores of its word and of the neighbours."""

    def __init__(self, field: Field):
        super().__init__()
        self.emit = field.model.emit.astype(np.float32)
        self.rows = np.zeros((1 << 12, 1 + len(AROUND), self.emit.shape[1]), np.float32)

    def __missing__(self, seen: tuple[bytes, ...] | None) -> int:
        number = len(self)
        if number == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        own, lent = look_features(seen)
        self.rows[number, 0] = self.emit[own].sum(axis=0)
        for role in range(len(AROUND)):
            self.rows[number, 1 + role] = self.emit[OWN + role * NEAR + np.array(lent)].sum(axis=0)
        if seen is None:
            self.rows[number, 0, 1:] = -np.inf  # outside, so that texts in a row do not touch
        self[seen] = number
        return number


class PersonalDataFinder:
    """Spans of a batch of texts: (kind number, start, end, base) in bytes, by kind and start."""

    #: Different words, and looks of words, that are remembered from batch to batch.
    WORDS, LOOKS = 100_000, 50_000

    def __init__(self, field: Field):
        self.field = field
        self._reset()

    def _reset(self) -> None:
        known = self.field.known
        self.looks = looks = _Looks(self.field)
        self.words = Memo(lambda word: looks[None if word is None else look(word, known)], self.WORDS)
        move = self.field.model.move
        # Runs stand between words that are certainly outside.
        self.decoder = Crf(self.field.model.emit, move, move[0], move[:, 0])
        # How much the transitions can speak for a label against outside, at most.
        self.margin = (move - move[:, :1]).max(axis=0) + (move - move[:1]).max(axis=1)

    def __getstate__(self):
        return {"field": self.field}

    def __setstate__(self, state):
        self.__init__(state["field"])

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int, bool]]]:
        found = [[(*s, True) for s in base_spans(t)] for t in texts]
        for k, marks in self._marked(texts).items():
            found[k] += _added(texts[k], marks, found[k], self.field)
        for spans in found:
            spans.sort()
        return found

    def _marked(self, texts: list[bytes]) -> dict[int, dict[int, int]]:
        """By text: label of each word (by number) that is not outside."""
        if len(self.looks) > self.LOOKS:
            self._reset()
        words: list[bytes | None] = [None, None]
        first = np.zeros(len(texts) + 1, np.int64)
        for k, text in enumerate(texts):
            first[k] = len(words)
            words += text.split()
            words += (None, None)
        first[-1] = len(words)
        kinds = np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))
        place, scores = self._uncertain(kinds)
        marks = self._decoded(place, scores)
        hit = np.flatnonzero(marks)
        owner = np.searchsorted(first, place[hit], side="right") - 1
        out: dict[int, dict[int, int]] = {}
        for k, at, mark in zip(owner.tolist(), (place[hit] - first[owner]).tolist(), marks[hit].tolist()):
            out.setdefault(k, {})[at] = mark
        return out

    def _uncertain(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the words that some best path may label.

        All others have a lead for outside that no transitions can make up for,
        so the best path passes through outside there and the words between
        them can be decoded by themselves.
        """
        places, scores = [np.zeros(0, np.int64)], [np.zeros((0, self.looks.rows.shape[2]), np.float32)]
        reach = max(map(abs, AROUND))
        for at in range(reach, len(kinds) - reach, BLOCK):
            stop = min(at + BLOCK, len(kinds) - reach)
            part = self.looks.rows[kinds[at:stop], 0]
            for role, away in enumerate(AROUND):
                part += self.looks.rows[kinds[at + away : stop + away], 1 + role]
            open_ = np.flatnonzero((part[:, 1:] + self.margin[1:] >= part[:, :1]).any(axis=1))
            places.append(open_ + at)
            scores.append(part[open_])
        return np.concatenate(places), np.concatenate(scores)

    def _decoded(self, place: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Best label of each uncertain word, by Viterbi over runs of neighbouring ones."""
        marks = np.zeros(len(place), np.int8)
        if not len(place):
            return marks
        starts = np.concatenate(([0], np.flatnonzero(np.diff(place) != 1) + 1))
        sizes = np.diff(np.concatenate((starts, [len(place)])))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        at = 0
        while at < len(sizes):
            end = min(len(sizes), at + max(1, CELLS // int(sizes[at])))
            n, longest = sizes[at:end], int(sizes[at])
            row = np.repeat(np.arange(end - at), n)
            col = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            batch = np.zeros((end - at, longest, scores.shape[1]), np.float32)
            source = np.repeat(starts[at:end], n) + col
            batch[row, col] = scores[source]
            marks[source] = self.decoder.viterbi(batch, n)[row, col]
            at = end
        return marks


def _by_lines(data: bytes, places: list[tuple[int, int]], run: list[int]) -> list[list[int]]:
    """A run of words cut at line ends; of several parts, those of two words or more."""
    first, end, mark = run
    cuts = [k for k in range(first + 1, end) if _LINE_END.search(data, places[k - 1][1], places[k][0])]
    parts = [[a, b, mark] for a, b in zip([first, *cuts], [*cuts, end])]
    return [p for p in parts if p[1] - p[0] > 1] if cuts else parts


def _added(data: bytes, marks: dict[int, int], base: list[tuple[int, int, int, bool]], field: Field) -> list[tuple[int, int, int, bool]]:
    """Spans of neighbouring words with one label, trimmed of marks around them, that touch no base span.

    A name does not cross line ends. Spans unlike all labelled ones are dropped
    (``Field.allows``); a card number must pass Luhn's test.
    """
    places, name = [m.span() for m in _WORD.finditer(data)], 1 + KINDS.index("name")
    runs: list[list[int]] = []
    for at in sorted(marks):
        if runs and runs[-1][1] == at and marks[at] == runs[-1][2]:
            runs[-1][1] = at + 1
        else:
            runs.append([at, at + 1, marks[at]])
    starts = sorted((a, b) for _, a, b, _ in base)
    highest = [0]
    for _, b in starts:
        highest.append(max(highest[-1], b))
    runs = [run for run in runs if run[1] - run[0] <= 2 * field.usual[run[2] - 1].most]
    out = []
    for first, end, mark in chain.from_iterable(_by_lines(data, places, run) if run[2] == name else [run] for run in runs):
        start, stop = places[first][0], places[end - 1][1]
        part = data[start:stop]
        trim = _TRIM.encode() if mark - 1 != KINDS.index("phone") else _TRIM.replace("(", "").encode()
        start += len(part) - len(part.lstrip(trim))
        stop -= len(part) - len(part.rstrip(_TRIM.encode()))
        if start >= stop or highest[bisect_left(starts, (stop,))] > start:
            continue
        if field.allows(mark - 1, data[start:stop]):
            out.append((mark - 1, start, stop, False))
    return out


def _finder(docs: DataFrame, labelled: DataFrame | None, most: int):
    fitted = default_field() if labelled is None else field_of(labelled, most)
    return docs.sparkSession.sparkContext.broadcast(PersonalDataFinder(fitted))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None, most: int = TRAIN_TEXTS
) -> DataFrame:
    """(doc_id, spans) for every row; spans are (kind, start, end, base) by kind (as in ``KINDS``) and start.

    Offsets are code points, ends exclusive. ``base`` spans are the exact
    patterns' (leftmost, non-overlapping within a kind); the others come from
    the field and overlap no base span. ``labelled`` (text, spans) replaces the
    package's table, of which at most about ``most`` different rows are fitted.
    Null and empty texts have no spans, repeated rows are all returned, null
    ids stay null, other columns are ignored.
    """
    sent = _finder(docs, labelled, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        for batch in slices(batches):
            texts, rows = raw(batch.column(1)), []
            for text, spans in zip(texts, sent.value.spans(texts)):
                cuts = code_points(text, [x for s in spans for x in s[1:3]]) if spans else []
                rows.append([
                    {"kind": KINDS[k], "start": a, "end": b, "base": base}
                    for (k, _, _, base), a, b in zip(spans, cuts[::2], cuts[1::2])
                ])
            yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(struct))], ["doc_id", "spans"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id long, spans {SPANS}")


def masked(data: bytes, spans: list[tuple[int, int, int, bool]]) -> bytes:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first and longest."""
    out, at = [], 0
    for start, stop, kind in sorted((a, -b, k) for k, a, b, _ in spans):
        if start >= at:
            out += [data[at:start], b"<", KINDS[kind].upper().encode(), b">"]
            at = -stop
        elif -stop > at:
            at = -stop
    return b"".join([*out, data[at:]])


def mask_personal_data(
    docs: DataFrame, text_col: str = "text", size_col: str = "n_chars",
    labelled: DataFrame | None = None, most: int = TRAIN_TEXTS,
) -> DataFrame:
    """``docs`` with all found spans masked in the text; all rows and columns stay.

    ``size_col``, if there is such a column, is set to the new text's length.
    Null texts become empty.
    """
    sent = _finder(docs, labelled, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            texts = raw(batch.column(at))
            clean = [masked(t, s) for t, s in zip(texts, sent.value.spans(texts))]
            yield batch.set_column(at, text_col, pa.array(clean, pa.binary()).cast(pa.string()))

    out = docs.mapInArrow(run, docs.schema)
    if size_col not in docs.columns:
        return out
    return out.withColumn(size_col, F.length(text_col).cast(docs.schema[size_col].dataType))
