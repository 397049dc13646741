"""The small labelled table that the field of ``pii`` is fitted on.

Sentences are patterns with marked slots; names, streets, numbers and dates are
drawn by rule, so no value is that of a person. ``{kind:form}`` is a labelled
span, ``[form]`` is filled but outside. Held-out patterns and word stocks serve
the tests alone.
"""

from __future__ import annotations

import random
import re

#: Patterns of labelled sentences in English, German, French and Spanish.
PATTERNS = """
my name is {name:full} and
hello , my name is {name:full} .
this is {name:full} from the office
Dear {name:titled} ,
please contact {name:full} at {phone:local}
please contact {name:full} for more
signed by {name:full} on [dated]
Sincerely , {name:full}
Best regards , {name:full}
Contact : {name:full}
Name : {name:full}
patient {name:full} , born {birth:date} ,
{name:titled} called on Monday
we met {name:titled} in the hall
ask {name:titled} about it
written by {name:full} in [year]
the account of {name:full} was closed
customer {name:full} , {address:en}
employee {name:full} lives at {address:en} .
lives at {address:en} and
our office is at {address:en} .
ship to {address:en} before noon
Address : {address:en}
send it to {address:en} please
mailing address {address:en}
he was born on {birth:date} in the
date of birth : {birth:date}
DOB : {birth:date}
DOB {birth:date}
born {birth:date}
birthday is {birth:date} .
call me at {phone:local} .
call {phone:local} today
phone : {phone:local}
Tel : {phone:local}
tel. {phone:local} or
my number is {phone:local} and
fax {phone:local} ,
text us on {phone:local}
mobile {phone:local}
reach me at {email:spelled} .
email me at {email:spelled} today
write to {email:spelled} or
e-mail : {email:spelled}
mail {email:spelled}
mein Name ist {name:full} und
ich heiße {name:full} .
Herr {name:last} kommt morgen
Frau {name:last} hat gesagt
Sehr geehrte Frau {name:last} ,
Sehr geehrter Herr {name:last} ,
Mit freundlichen Grüßen {name:full}
Ansprechpartner : {name:full}
wohnhaft in der {address:de} .
Anschrift : {address:de}
wohnt in der {address:de} und
die Adresse lautet {address:de}
geboren am {birth:dotted} in der
Geburtsdatum : {birth:dotted}
geb. {birth:dotted}
Telefon : {phone:local}
Telefon {phone:local} oder
rufen Sie {phone:local} an
unter der Nummer {phone:local} zu
schreiben Sie an {email:spelled} bitte
je m' appelle {name:full} et
mon nom est {name:full} .
Monsieur {name:last} est venu
Madame {name:last} a dit
Cordialement , {name:full}
domicilié au {address:fr} .
habite au {address:fr} et
Adresse : {address:fr}
né le {birth:date} à la
née le {birth:date} .
date de naissance : {birth:date}
téléphone : {phone:local}
appelez le {phone:local} avant
écrivez à {email:spelled} pour
me llamo {name:full} y
mi nombre es {name:full} .
el señor {name:last} llegó
la señora {name:last} dijo
Atentamente , {name:full}
domicilio : {address:es}
vive en {address:es} con
con dirección en {address:es} .
nacido el {birth:date} en
nacida el {birth:date} .
fecha de nacimiento : {birth:date}
teléfono : {phone:local}
llame al {phone:local} hoy
escriba a {email:spelled} para
server at {ip:six} is down
address {ip:six} was seen
host {ip:six} answered
""".strip().splitlines()  # fmt: skip

#: Sentences without personal data: numbers, dates, capital letters, codes and street words in other uses.
PLAIN = """
in [year] we sold [n] of [n] units
the meeting is on [dated] in room [n] .
Chapter [n] . The [Cap] and the [Cap]
it costs [n] . [n] in total , see page [n]
order [n] - [n] was sent on [dated]
version [n] . [n] . [n] of the program
Licensed under the Apache License , Version 2.0.
Licensed under CC BY-NC 4.0.
Copyright [year] The [Cap] Authors
token = " [hex] "
the year [year] was good
[Cap] [word] [word] the [word] .
[Cap] [word] , [word] and [word] [Cap] [word] .
[word] [word] [Cap] [word] [word]
[CAPS]!! [CAPS] [CAPS]!!
der [Cap] und die [Cap] in der [Cap] .
die [Cap] des [Cap] ist ein [Cap]
[word] | [n] | [word] | [word]
the [word] at the [word] is in the street
a [word] of [n] [word] and [n] [word]
he called at [n] and left
she was born in the [word] of [word]
the name of the [word] is [word]
my name is on the list
die Straße ist lang und der Platz groß
la rue est longue et la place grande
la calle es larga y la plaza grande
Dear reader , please note the [word]
Dear all , the [word] is here
contact the office for [word]
contact us at the desk
the phone is new , [n] more
the number is [n]
call the [word] at noon
a total of [code] items
part [code] costs [n]
isbn [long] is [word]
serial [long] and [long]
[word] at [word] dot
write to the [word] or the [word]
the address of the [word] was [word]
date : [dated]
on [dated] the [word] began
lo [word] del [word] , la [word] es [word]
le [word] du [word] , la [word] est [word]
[Cap] [Cap] [word] . [Cap] [word]
[Cap] . [Cap] [word] , [word]
[Cap] de [word] la [word] que el [word] de [word] . De [word] los [word]
[word] de . La [word] [word] el de [Cap] . Su de [word] , y [word]
[word] le [word] . De [word] et la [word] de . Les [word] des [word]
De [word] du [word] . La de [word] le [word] en . [Cap] de [word]
[word] der [Cap] und . Der [word] die [Cap] den [Cap] , in das [Cap]
die . Und [Cap] von der [Cap] [word] . Mit [Cap] [word] zu
[word] the [word] . Of [word] and [word] . By . [Cap] [word] , in the
the . And [word] of [word] . The [word] to . [Cap] was [word]
[word] . [Cap] . [Cap] [word] [word]
under the GNU General Public License version [n]
licensed under the GNU General Public License, version [n]
[word]%%% [word]$$$ [word]### [word]&&& [Cap]*** [word]%%% the%%% of%%% [word]### in***
de%%% [Cap]%%% la$$$ y&&& [word]*** [word]### et%%% le%%% is%%% [word]&&& [Cap]&&&
to%%% [word]%%% [word]%%% is%%% [Cap]*** [word]*** a$$$ [word]$$$ and$$$
[CAPS] [CAPS] [CAPS] [CAPS] [CAPS]. [CAPS] [CAPS]. [CAPS]
[CAPS]!! [CAPS]!! THE!! [CAPS]!! [CAPS]. [CAPS] IS!! [CAPS]
[same] [word]
[same]
[word]. [same] [Cap] [word]
[Cap] [Cap] [Cap] [Cap] [Cap] [Cap] [word]
[word] | [word] [word] | [Cap] [word] | [word] , [Cap] | [word]
[Cap]. [Cap]. [Cap]. [Cap] [Cap]. [Cap]. [word]
[Cap] | [word] [Cap] | [Cap] [Cap]
[Cap] [Cap] [Cap] . [word] [word]
Guten Tag , das ist ein [word]
from [n] to [n] ( [n] %)
[n] [n] [n] [n]
I am at the [word] with [n] [word]
[word] [mail] [word]
[word] [dot4] [word]
[word] [plus] [word]
[mail] [plus] [dot4]
[word] [card] [word]
[Cap] [word] [mail]
[word] [dot4]. [Cap]
""".strip().splitlines()

#: Patterns of the tests alone.
HELD_PATTERNS = """
good morning , my name is {name:full} and I
Kind regards , {name:full}
please call {name:full} at {phone:local} tomorrow
for questions contact {name:full} or the desk
we spoke with {name:titled} about it
the customer {name:full} was born on {birth:date} .
she lives at {address:en} with
my address : {address:en}
phone {phone:local} , fax {phone:local}
you can call {phone:local} any time
you can email me at {email:spelled} now
Guten Tag , mein Name ist {name:full} .
gestern hat Frau {name:last} gesagt
er wohnt in der {address:de} mit
sie wurde geboren am {birth:dotted} in
Telefon : {phone:local} oder
bonjour , je m' appelle {name:full} .
il habite au {address:fr} avec
elle est née le {birth:date} en
hola , me llamo {name:full} .
ella vive en {address:es} y
teléfono : {phone:local} o
""".strip().splitlines()

_STARTS = "b br c d f g h j k l m n p r s st t v w".split()
_MIDDLES = "a e i o u ai ei au é ö".split()
_ENDS = "l n r s t m nd rt ck x".split()
_TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Mr.", "Mrs.", "Dr.")
_MONTHS = "January February March April May June July August September October November December".split()
_STREETS = {
    "en": ("Street", "Road", "Avenue", "Lane", "Drive", "St.", "Ave.", "Boulevard"),
    "de": ("straße", "weg", "gasse", "allee"),
    "fr": ("rue", "avenue", "boulevard", "place"),
    "es": ("Calle", "Avenida", "Plaza", "calle"),
}


class Filler:
    """Draws the values of slots."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def syllables(self, low: int, high: int) -> str:
        r = self.rng
        return "".join(r.choice(_STARTS) + r.choice(_MIDDLES) + (r.choice(_ENDS) if r.random() < 0.3 else "") for _ in range(r.randint(low, high)))

    def word(self) -> str:
        return self.syllables(1, 3) + self.rng.choice(["", "", "", ",", "."])

    def cap(self) -> str:
        return self.syllables(1, 3).capitalize()

    def digits(self, n: int) -> str:
        return "".join(self.rng.choice("0123456789") for _ in range(n))

    def name(self, form: str) -> str:
        r = self.rng
        last = self.cap() + (r.choice(["", "", "", "-" + self.cap()]))
        if form == "last":
            return last
        if form == "titled":
            return f"{r.choice(_TITLES)} {last}" if r.random() < 0.5 else f"{r.choice(_TITLES)} {self.cap()} {last}"
        middle = r.choice(["", "", "", self.cap()[0] + ". ", self.cap() + " "])
        return f"{self.cap()} {middle}{last}"

    def address(self, form: str) -> str:
        r, n = self.rng, str(self.rng.randint(1, 999))
        zip_, town = self.digits(5), self.cap()
        if form == "en":
            tail = r.choice(["", f", {town}", f", {town} {zip_}", f", Apt {r.randint(1, 40)}", f", {town}, {r.choice(['CA', 'NY', 'TX', 'OR'])} {zip_}"])
            return f"{n} {self.cap()} {r.choice(_STREETS['en'])}{tail}"
        tail = r.choice(["", f", {zip_} {town}", f", {town}"])
        if form == "de":
            return f"{self.cap()}{r.choice(_STREETS['de'])} {n}{tail}"
        if form == "fr":
            return f"{n} {r.choice(_STREETS['fr'])} {r.choice(['de ', 'du ', 'des ', ''])}{town}{tail}"
        return f"{r.choice(_STREETS['es'])} {r.choice(['', 'de ', 'del '])}{town} {n}{tail}"

    def phone(self) -> str:
        r, d = self.rng, self.digits
        return r.choice([
            f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"0{d(3)} {d(7)}",
            f"0{d(2)}/{d(7)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"0{d(9)}", f"{d(3)} {d(2)} {d(2)} {d(2)}", f"0{d(3)}-{d(6)}",
        ])

    def birth(self, form: str) -> str:
        r, day, month, year = self.rng, self.rng.randint(1, 28), self.rng.randint(1, 12), self.rng.randint(1930, 2012)
        if form == "dotted":
            return f"{day:02d}.{month:02d}.{year}"
        return r.choice([f"{month:02d}/{day:02d}/{year}", f"{day:02d}/{month:02d}/{year}", f"{year}-{month:02d}-{day:02d}",
                         f"{day} {r.choice(_MONTHS)} {year}", f"{r.choice(_MONTHS)} {day}, {year}", f"{day:02d}-{month:02d}-{year}"])

    def email(self) -> str:
        r, user, host = self.rng, self.syllables(1, 3), self.syllables(1, 2)
        end = r.choice(["com", "org", "net", "de", "fr", "es"])
        return r.choice([f"{user} at {host} dot {end}", f"{user} [at] {host}.{end}", f"{user} (at) {host} (dot) {end}", f"{user}[at]{host}[dot]{end}",
                         f"{user} AT {host} DOT {end}", f"{user} [at] {host} [dot] {end}", f"{user}(at){host}.{end}"])

    def ip(self) -> str:
        r = self.rng
        part = lambda: f"{r.randrange(1, 65536):x}"
        return ":".join(part() for _ in range(8)) if r.random() < 0.5 else f"fe80::{part()}:{part()}"

    def span(self, kind: str, form: str) -> str:
        draw = {"phone": self.phone, "email": self.email, "ip": self.ip}.get(kind)
        return draw() if draw else getattr(self, kind)(form)

    def outside(self, form: str) -> str:
        r, d = self.rng, self.digits
        if form == "same":
            return " ".join([r.choice([self.cap(), self.word(), "Of", "De", "At", "Was"])] * r.randint(3, 25))
        if form in ("word", "year", "n", "Cap", "CAPS"):
            return {"word": self.word, "year": lambda: str(r.randint(1900, 2030)), "n": lambda: d(r.randint(1, 6)), "Cap": self.cap,
                    "CAPS": lambda: self.cap().upper()}[form]()
        return {
            "hex": lambda: "".join(r.choice("0123456789abcdef") for _ in range(40)),
            "long": lambda: d(r.randint(9, 20)),
            "card": lambda: d(16),
            "code": lambda: f"{d(2)}-{d(2)}-{self.cap().upper()}",
            "dated": lambda: r.choice([f"{r.randint(1, 28)} {r.choice(_MONTHS)} {r.randint(1990, 2030)}", f"{d(2)}/{d(2)}/{r.randint(1990, 2030)}"]),
            "mail": lambda: f"{self.syllables(1, 2)}.{d(2)}@mail{d(1)}.example.com",
            "dot4": lambda: ".".join(str(r.randrange(256)) for _ in range(4)),
            "plus": lambda: f"+1 ({d(3)}) {d(3)}-{d(4)}",
        }[form]()


_SLOT = re.compile(r"\{(\w+):(\w+)\}|\[(\w+)\]")
#: Kinds whose plain forms the exact patterns already find; the field learns them as spans of the same kind.
_PLAIN_KINDS = {"mail": "email", "dot4": "ip", "plus": "phone"}


def _filled(pattern: str, filler: Filler) -> tuple[str, list[tuple[str, int, int]]]:
    text, spans, at = "", [], 0
    for m in _SLOT.finditer(pattern):
        text += pattern[at : m.start()]
        at = m.end()
        kind = m[1] or _PLAIN_KINDS.get(m[3])
        value = filler.outside(m[3]) if m[3] else filler.span(m[1], m[2])
        if kind:
            spans.append((kind, len(text), len(text) + len(value)))
        text += value
    text += pattern[at:]
    lead = " ".join(filler.word() for _ in range(filler.rng.randint(0, 4)))
    tail = " ".join(filler.word() for _ in range(filler.rng.randint(0, 4)))
    shift = len(lead) + 1 if lead else 0
    whole = f"{lead} {text} {tail}".strip() if lead else f"{text} {tail}".strip()
    # A comma or full stop of the pattern is written next to the word before it in half of the sentences.
    spans = [(k, a + shift, b + shift) for k, a, b in spans]
    if filler.rng.random() < 0.5:
        return _closed(whole, spans)
    return whole, spans


def _closed(text: str, spans: list[tuple[str, int, int]]) -> tuple[str, list[tuple[str, int, int]]]:
    """The text without blanks before commas, colons and full stops, and its spans there."""
    gone = [m.start() for m in re.finditer(r" (?=[,.:](\s|$))", text)]
    moved = [(k, a - sum(g < a for g in gone), b - sum(g < b for g in gone)) for k, a, b in spans]
    return "".join(c for i, c in enumerate(text) if i not in set(gone)), moved


def examples(patterns: list[str], copies: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, [(kind, start, end)]), ``copies`` of each pattern; offsets are code points."""
    filler = Filler(seed)
    return [_filled(p, filler) for p in patterns for _ in range(copies)]


def labelled_examples() -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The table that the field is fitted on where none is given."""
    return examples(PATTERNS, 12, 1) + examples(PLAIN, 9, 2)


def held_out_examples() -> list[tuple[str, list[tuple[str, int, int]]]]:
    return examples(HELD_PATTERNS, 12, 77)
