"""Personal data replaced by keyed surrogates.

Detected entities (mail and IP addresses of both kinds, phone, card and bank
account numbers, social security numbers, secrets, names of people) each get a
surrogate of their own type, made from a keyed hash of the entity's canonical
form. It keeps the format: lengths, punctuation, upper and lower case, digits
where digits were, the script of letters, check digits of cards and accounts.
One entity has one surrogate in all documents, so references stay together;
upper and lower case spellings of one entity share a surrogate, each in its
case.

A name begins after a form of address or a phrase like "my name is", or with a
common first name before another capitalised word. It goes on over capitalised
words, initials and particles, any number of them; hyphens and apostrophes part
words and stay. Its words are the entities: the last one is the surname, those
before are given names, whose gender the form of address or the name itself
tells. So "Mr. John Smith", "Mr. Smith" and a later "Smith" of the same text
stay one person, as each word has its own surrogate. An initial becomes another
one.

Distinct entities must stay distinct and must not become another real entity.
The corpus's distinct entities are gathered (a hot one is one row after partial
aggregation), their surrogates compared with each other and with all entities,
and the losers of a collision hashed again until none is left; invented names
grow longer with the attempts, so that their number has no bound. Texts are
rewritten in a second pass, which detects again where a sketch of the documents
with entities says so. The few entities that needed another attempt travel with
the task while they are at most ``most_retries``, beyond that they are joined
to the documents that hold them.

Null text stays null. Each input row gives a row, repeated ones too; texts are
read whole, however long; an empty table gives an empty result. Carried columns
may have any names, but those of results give way to these. The key is a secret
of whoever runs the job; without it surrogates can't be linked to entities.

What has neither a form of its own nor words that tell it is not found: names
without any of the signs above, bare numbers without a word like "phone" before
them, postal addresses.
"""

from __future__ import annotations

import bisect
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Kinds of mentions, the earlier one first where they overlap.
KINDS = ("email", "secret", "iban", "ip", "ssn", "card", "phone", "name")

# Forms of address with the gender they tell, phrases before a name, and common first names.
ADDRESS = {"mr": "m", "mister": "m", "mrs": "f", "ms": "f", "miss": "f", "herr": "m", "herrn": "m", "frau": "f", "monsieur": "m", "madame": "f", "mme": "f", "mlle": "f", "señor": "m", "señora": "f", "señorita": "f", "dr": "", "prof": "", "господин": "m", "госпожа": "f", "κύριος": "m", "κυρία": "f"}
PHRASES = ("my name is ", "name is ", "ich heiße ", "mein name ist ", "je m'appelle ", "me llamo ", "mi nombre es ", "меня зовут ")
PARTICLES = {"van", "von", "der", "den", "de", "da", "di", "del", "della", "la", "le", "bin", "ibn", "al", "zu", "dos", "das", "du"}
SUFFIXES = {"jr", "sr", "ii", "iii", "iv", "phd", "md"}
FIRST_NAMES = {
    ("latin", "m"): ("James", "John", "Robert", "Michael", "David", "Thomas", "Daniel", "Paul", "Peter", "Martin", "Lukas", "Pierre", "Louis", "Carlos", "Pablo", "Diego", "William", "Richard", "Joseph", "Charles", "Christopher", "Matthew", "Anthony", "Steven", "Andrew", "George", "Kevin", "Brian", "Edward", "Hans", "Stefan", "Klaus", "Jean", "François", "José", "Juan", "Luis", "Miguel", "Antonio", "Marco", "Giovanni"),
    ("latin", "f"): ("Mary", "Linda", "Susan", "Sarah", "Anna", "Laura", "Julia", "Emma", "Sophie", "Claire", "Marie", "Camille", "Elena", "Lucia", "Carmen", "Isabel", "Patricia", "Jennifer", "Elizabeth", "Barbara", "Jessica", "Karen", "Nancy", "Lisa", "Margaret", "Sandra", "Ashley", "Emily", "Michelle", "Amanda", "Rebecca", "Katharina", "Petra", "Sabine", "Ursula", "Françoise", "Isabelle", "María", "Ana", "Giulia"),
    ("cyrillic", "m"): ("Иван", "Пётр", "Сергей", "Андрей", "Дмитрий", "Павел", "Михаил", "Николай"),
    ("cyrillic", "f"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Светлана", "Вера"),
    ("greek", "m"): ("Γιώργος", "Νίκος", "Δημήτρης", "Κώστας"),
    ("greek", "f"): ("Ελένη", "Κατερίνα", "Σοφία", "Μαρία"),
}
#: Scripts by their ranges, and the parts that invented names are made of: letters, endings by gender.
SCRIPTS = {
    "latin": ((0x41, 0x24F), "bdfghklmnprst", "aeo", {"m": "nrst", "f": "a", "": ""}),
    "greek": ((0x370, 0x3FF), "βγδκλμνπρστ", "αεο", {"m": "ς", "f": "α", "": ""}),
    "cyrillic": ((0x400, 0x52F), "бвгдзклмнпрст", "аео", {"m": "нрст", "f": "а", "": ""}),
    "armenian": ((0x531, 0x587), "", "", {}),
    "hebrew": ((0x5D0, 0x5EA), "", "", {}),
    "arabic": ((0x621, 0x64A), "", "", {}),
    "devanagari": ((0x904, 0x939), "", "", {}),
    "thai": ((0xE01, 0xE2E), "", "", {}),
    "georgian": ((0x10D0, 0x10F0), "", "", {}),
    "hiragana": ((0x3042, 0x3093), "", "", {}),
    "katakana": ((0x30A2, 0x30F3), "", "", {}),
    "han": ((0x4E00, 0x9FA5), "", "", {}),
    "hangul": ((0xAC00, 0xD7A3), "", "", {}),
}
GENDER_OF = {name.lower(): g for (_, g), names in FIRST_NAMES.items() for name in names}
_COMMON = {name for names in FIRST_NAMES.values() for name in names}


@lru_cache(maxsize=10_000)
def script_of(c: str) -> str:
    """The script of a letter; Latin for those of no other one here."""
    return next((name for name, ((a, b), *_) in SCRIPTS.items() if a <= ord(c) <= b), "latin")


@lru_cache(maxsize=None)
def letters_of(script: str) -> list[str]:
    """Lower-case letters of a script, plain ones for Latin."""
    a, b = (0x61, 0x7A) if script == "latin" else (0x430, 0x44F) if script == "cyrillic" else (0x3B1, 0x3C9) if script == "greek" else SCRIPTS[script][0]
    return [chr(k) for k in range(a, b + 1) if chr(k).isalpha() and chr(k) == chr(k).lower() and chr(k) != "ς"]


_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
PATTERNS = {
    "email": re.compile(r"[^\W_][\w.+%-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "secret": re.compile(r"""(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)\b\s*[:=]\s*["']?)([A-Za-z0-9+/_=-]{8,})|(?<![A-Za-z0-9])((?:[0-9a-f]{32,}|[0-9A-F]{32,}))(?![A-Za-z0-9])|\b((?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}))\b"""),
    "ip": re.compile(rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)"),
    "ipv6": re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "card": re.compile(r"(?<![\w.-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![\w-])"),
    "phone": re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w-])|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])"),
}
#: A word of a name: runs of letters with hyphens and apostrophes between them, without a genitive's end.
_WORD = re.compile(r"[^\W\d_]+(?:(?:-|['\u2019](?![sS]\b))[^\W\d_]+)*")
_RUN = re.compile(r"[^\W\d_]+")
#: Between a form of address and a name, and between a name's words.
_AFTER, _BETWEEN = re.compile(r"\.?[ \t]+"), re.compile(r"\.?[ \t]+")
#: Where digits are; the numeric patterns are tried there only, with a character before and two after.
_NUMERIC = re.compile(r"[+(]{0,2}\d[\d .()+-]*")
#: Words before a bare number that make it a phone number.
_CALL = re.compile(r"(?:phone|tel|telephone|telefon|téléphone|teléfono|mobile|cell|handy|call|fax|whatsapp|тел|телефон)\b[ .:#=]{0,3}(?:no\.?|number|nr\.?|is|at|me at)?[ .:#=]{0,3}$")
_LABELS = ("token", "secret", "passw", "key", "auth", "akia", "sk-", "ghp_", "gho_", "ghu_", "ghs_", "ghr_")

#: (begin, end, place in KINDS, canonical form)
Found = tuple[int, int, int, str]


def _emails(text: str) -> Iterator[tuple[int, int, int, str]]:
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > 0 and (text[begin - 1].isalnum() or text[begin - 1] in "_.+%-"):
            begin -= 1
        while begin < at and not text[begin].isalnum():
            begin += 1
        if m := PATTERNS["email"].match(text, begin):
            yield m.start(), m.end(), 0, m[0].lower()
        at = text.find("@", at + 1)


def _numbers(text: str) -> Iterator[Found]:
    for region in _NUMERIC.finditer(text):
        if region.end() - region.start() < 7:
            continue
        first = max(0, region.start() - 1)
        near = text[first : region.end() + 2]
        for name in ("ip", "ssn", "card", "phone"):
            for m in PATTERNS[name].finditer(near):
                canon = m[0] if name == "ip" else re.sub(r"\D", "", m[0])
                if name == "phone" and m[0][0] == "+":
                    code = re.match(r"\d+", m[0][1:])[0]
                    code = code if len(code) <= 3 else code[:1]
                    canon = f"+{code} {canon[len(code):]}"
                yield first + m.start(), first + m.end(), KINDS.index(name), canon
        digits = region[0].rstrip(" .()+-")
        if digits.isdigit() and 7 <= len(digits) <= 15 and _CALL.search(text[max(0, region.start() - 30) : region.start()].lower()):
            yield region.start(), region.start() + len(digits), KINDS.index("phone"), digits


def _ipv6(text: str) -> Iterator[Found]:
    if text.count(":") < 2:
        return
    for m in PATTERNS["ipv6"].finditer(text):
        try:
            ipaddress.IPv6Address(m[0])
        except ValueError:
            continue
        if any(c.isalnum() for c in m[0]) and (m[0].count(":") > 2 or "::" in m[0]) and sum(c.isalnum() for c in m[0]) > 3:
            yield m.start(), m.end(), KINDS.index("ip"), m[0].lower()


def _rest_97(account: str) -> int:
    """An account number is valid if this is 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def _accounts(text: str) -> Iterator[Found]:
    for m in PATTERNS["iban"].finditer(text):
        canon = m[0].replace(" ", "")
        if 15 <= len(canon) <= 34 and _rest_97(canon) == 1:
            yield m.start(), m.end(), KINDS.index("iban"), canon.lower()


class _Names:
    """The names of a text, as places of words with their canonical forms:
    "surname=smith" or "given=m:john"."""

    def __init__(self, text: str, lower: str):
        self.text, self.lower = text, lower
        self.words: dict[int, tuple[int, str, str]] = {}  # begin: end, role, gender
        for form, gender in ADDRESS.items():
            for end in self._after(form):
                if m := _AFTER.match(text, end):
                    self._name(m.end(), gender, 1)
        for phrase in PHRASES:
            for end in self._after(phrase):
                self._name(end, "", 1)
        if not _COMMON.isdisjoint(text.split()):
            for m in _WORD.finditer(text):
                if m[0] in _COMMON and m.start() not in self.words:
                    self._name(m.start(), "", 2)
        if self.words:
            self._bare()

    def _after(self, form: str) -> Iterator[int]:
        at = self.lower.find(form)
        while at >= 0:
            end = at + len(form)
            if (at == 0 or not (self.text[at - 1].isalnum() or self.text[at - 1] == "_")) and (form[-1] == " " or end == len(self.text) or not self.text[end].isalnum()):
                yield end
            at = self.lower.find(form, end)

    def _name(self, at: int, gender: str, least: int) -> None:
        """Takes the words from ``at`` on that make a name, if there are
        ``least`` of them."""
        found: list[tuple[int, int]] = []
        end = at
        while m := _WORD.match(self.text, at):
            word = m[0]
            # Scripts without case have no capitals; a long run there is a sentence.
            named = word[0].isupper() or (word[0].lower() == word[0].upper() and len(word) <= 6)
            if named and word.lower() not in SUFFIXES:
                found.append((at, m.end()))
                end = m.end()
            elif not found or word.lower() not in PARTICLES | SUFFIXES:
                if word.lower() not in PARTICLES:
                    break
            gap = _BETWEEN.match(self.text, m.end())
            # A full stop goes on with a name after an initial or a suffix only.
            if not gap or (gap[0][0] == "." and len(word) > 1 and word.lower() not in SUFFIXES):
                break
            at = gap.end()
        if len(found) < least:
            return
        for k, (a, b) in enumerate(found):
            word = self.text[a:b].lower()
            surname = k == len(found) - 1 and (k > 0 or word not in GENDER_OF)
            for run in _RUN.finditer(self.text, a, b):
                self.words[run.start()] = (run.end(), "surname" if surname else "given", "" if surname else GENDER_OF.get(word) or gender)

    def _bare(self) -> None:
        """The names found so far, wherever else they stand in the text; a
        given name has one gender in a text, if anything tells it."""
        roles: dict[str, tuple[str, str]] = {}
        for a, (b, role, gender) in sorted(self.words.items()):
            word = self.text[a:b].lower()
            known = roles.get(word)
            if known is None or (known[0] == role and not known[1]):
                roles[word] = role, gender
        self.roles = roles
        spellings = {self.text[a:b] for a, (b, _, _) in self.words.items() if b - a > 1}
        for spelling in spellings | {s.upper() for s in spellings} | {s.title() for s in spellings}:
            at = self.text.find(spelling)
            while at >= 0:
                end = at + len(spelling)
                if at not in self.words and (at == 0 or not self.text[at - 1].isalnum()) and (end == len(self.text) or not self.text[end].isalnum()):
                    self.words[at] = (end, *roles.get(spelling.lower(), ("surname", "")))
                at = self.text.find(spelling, end)

    def mentions(self) -> Iterator[Found]:
        """Words with nothing but spaces, initials' full stops, hyphens,
        apostrophes and particles between them are one mention."""
        held: list[tuple[int, int, str]] = []
        for a, (b, _, _) in sorted(self.words.items()):
            word = self.text[a:b].lower()
            role, gender = self.roles[word] if word in self.roles else self.words[a][1:]
            canon = f"initial={word}" if len(word) == 1 and word.upper() != word else f"{role}={word}" if role == "surname" else f"given={gender}:{word}"
            if held and not self._joins(self.text[held[-1][1] : a]):
                yield held[0][0], held[-1][1], KINDS.index("name"), " ".join(x[2] for x in held)
                held = []
            if not held or a >= held[-1][1]:
                held.append((a, b, canon))
        if held:
            yield held[0][0], held[-1][1], KINDS.index("name"), " ".join(x[2] for x in held)

    @staticmethod
    def _joins(gap: str) -> bool:
        return len(gap) < 30 and "\n" not in gap and all(w.lower() in PARTICLES for w in _RUN.findall(gap)) and not set(gap) - set(" \t.-'\u2019") - {c for w in _RUN.findall(gap) for c in w}


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, canonical form) of the entities of a whole text, in
    order and apart; of overlapping ones the kind that comes first in KINDS
    wins, then the earlier and the longer. The canonical form of a name is that
    of each of its words, "role=word", joined by spaces."""
    if not text:
        return []
    found = list(_emails(text))
    lower = text.lower()
    if len(lower) != len(text):  # a few letters grow; then places would differ
        lower = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    if any(label in lower for label in _LABELS) or any(len(w) >= 32 for w in text.split()):
        for m in PATTERNS["secret"].finditer(text):
            k = next(k for k in (1, 2, 3) if m[k])
            found.append((m.start(k), m.end(k), 1, m[k].lower()))
    found += _numbers(text)
    found += _ipv6(text)
    found += _accounts(text)
    names = _Names(text, lower)
    if names.words:
        found += names.mentions()
    taken: list[tuple[int, int]] = []
    out = []
    for a, b, kind, canon in sorted(found, key=lambda x: (x[2], x[0], -x[1])):
        k = bisect.bisect_left(taken, (a, b))
        if (k == 0 or taken[k - 1][1] <= a) and (k == len(taken) or taken[k][0] >= b):
            taken.insert(k, (a, b))
            out.append((a, b, KINDS[kind], canon))
    return sorted(out)


def entities_of(kind: str, canon: str) -> list[tuple[str, str]]:
    """What a mention stands for: for a name, each word of more than a letter."""
    return [tuple(x.split("=", 1)) for x in canon.split(" ")] if kind == "name" else [(kind, canon)]


class Stream:
    """Numbers drawn from a keyed hash."""

    def __init__(self, key: bytes, *parts: object):
        self.key, self.label, self.pool, self.block = key, "\x1f".join(map(str, parts)).encode(), 0, 0
        self.room = 1

    def below(self, n: int) -> int:
        if self.room < n << 32:
            self.pool = int.from_bytes(hmac.digest(self.key, self.label + self.block.to_bytes(4, "big"), "sha256"), "big")
            self.room, self.block = 1 << 256, self.block + 1
        self.pool, x = divmod(self.pool, n)
        self.room //= n
        return x


def _luhn(digits: str) -> int:
    """The check digit that completes the digits."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return -total % 10


def _letters(text: str, s: Stream) -> str:
    """Digits to digits, letters to letters of the same script."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(s.below(10)))
        elif not c.isalpha():
            out.append(c)
        else:
            own = letters_of(script_of(c))
            out.append(own[s.below(len(own))])
    return "".join(out)


def _email(canon: str, s: Stream) -> str:
    # What a mail address looks like, at a domain that is reserved for examples.
    local, _, domain = canon.partition("@")
    labels = domain.split(".")
    head = labels[:-2]
    new = [_letters(x, s) for x in head] or [_letters(labels[0], s)]
    tail = labels[-1] if labels[-1] in ("com", "org", "net") else "com"
    return f"{_letters(local, s)}@{'.'.join(new)}.example.{tail}"


def _secret(canon: str, s: Stream) -> str:
    if re.fullmatch("[0-9a-f]+", canon):
        return "".join("0123456789abcdef"[s.below(16)] for _ in canon)
    return _letters(canon, s)


def _digits(n: int, s: Stream) -> str:
    return "".join(str(s.below(10)) for _ in range(n))


def _card(canon: str, s: Stream) -> str:
    body = canon[0] + _digits(len(canon) - 2, s)
    valid = _luhn(canon[:-1]) == int(canon[-1])
    return body + (str(_luhn(body)) if valid else str((_luhn(body) + 1 + s.below(9)) % 10))


def _phone(canon: str, s: Stream) -> str:
    code, _, rest = canon.rpartition(" ")  # a country code stays
    return f"{code} {_digits(len(rest), s)}" if code else _digits(len(rest), s)


def _invented(word: str, gender: str, size: int, s: Stream) -> str:
    """A name in the script of a word: syllables, or as many letters."""
    script = script_of(word[0])
    _, consonants, vowels, endings = SCRIPTS[script]
    if not consonants:
        own = letters_of(script)
        return "".join(own[s.below(len(own))] for _ in range(max(len(word), size - 2)))
    out = "".join(x[s.below(len(x))] for _ in range(size) for x in (consonants, vowels))
    return out + (endings[gender][s.below(len(endings[gender]))] if endings[gender] else "")


def _given(canon: str, s: Stream, attempt: int) -> str:
    gender, _, word = canon.partition(":")
    script = script_of(word[0])
    known = FIRST_NAMES.get((script, gender)) or FIRST_NAMES.get((script, "m"), ()) + FIRST_NAMES.get((script, "f"), ())
    if attempt < 3 and known:
        return known[s.below(len(known))].lower()
    return _invented(word, gender, 2 + attempt // 4, s)


def _iban(canon: str, s: Stream) -> str:
    body = _letters(canon[4:], s)
    return f"{canon[:2]}{98 - _rest_97(canon[:2] + '00' + body):02}{body}"


def _ip(canon: str, s: Stream) -> str:
    if ":" not in canon:
        return ".".join(str(1 + s.below(254)) for _ in range(4))
    # Groups of the same lengths, none of which begins with 0.
    return ":".join("".join("123456789abcdef0"[s.below(15 if k == 0 else 16)] for k in range(len(group))) for group in canon.split(":"))


#: Makers of canonical forms, given the one they replace, a stream and the attempt.
_MAKERS: dict[str, Callable[[str, Stream, int], str]] = {
    "email": lambda canon, s, _: _email(canon, s),
    "secret": lambda canon, s, _: _secret(canon, s),
    "iban": lambda canon, s, _: _iban(canon, s),
    "ip": lambda canon, s, _: _ip(canon, s),
    "ssn": lambda canon, s, _: _digits(9, s),
    "card": lambda canon, s, _: _card(canon, s),
    "phone": lambda canon, s, _: _phone(canon, s),
    "given": _given,
    "surname": lambda canon, s, attempt: _invented(canon, "", 3 + attempt // 4, s),
    "initial": lambda canon, s, _: _letters(canon, s),
}


@lru_cache(maxsize=100_000)
def surrogate(key: bytes, kind: str, canon: str, attempt: int = 0) -> str:
    """The canonical form of an entity's surrogate; never the entity itself."""
    for again in range(1000):
        new = _MAKERS[kind](canon, Stream(key, kind, canon, attempt, again), attempt)
        if new != (canon.partition(":")[2] if kind == "given" else canon):
            return new
    raise AssertionError("no surrogate found")


def dressed(kind: str, original: str, new: str) -> str:
    """The surrogate's canonical form in the format of one occurrence."""
    if kind in ("ssn", "card", "phone"):
        digits = iter(re.sub(r"\D", "", new))
        return "".join(next(digits) if c.isdigit() else c for c in original)
    if kind == "iban":
        rest = iter(new.upper())
        return "".join(c if c == " " else next(rest) for c in original)
    if kind in ("given", "surname"):
        return new.upper() if original.isupper() else new[:1].upper() + new[1:] if original[0].isupper() else new
    if original.isupper():
        return new.upper()
    if kind == "secret" and any(c.isupper() for c in original):
        # Mixed case: each letter in the case of the one it replaces.
        return "".join(n.upper() if c.isupper() else n for c, n in zip(original, new, strict=True))
    return new


def rewrite(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, dict[str, int]]:
    """The text with surrogates, and how many mentions of each kind it had."""
    out, at, n = [], 0, dict.fromkeys(KINDS, 0)
    new = lambda kind, canon, old: dressed(kind, old, surrogate(key, kind, canon, attempts.get((kind, canon), 0)))
    for a, b, kind, canon in detect(text):
        out.append(text[at:a])
        at, n[kind] = b, n[kind] + 1
        if kind != "name":
            out.append(new(kind, canon, text[a:b]))
            continue
        # Word by word; what stands between them stays.
        words = iter(entities_of(kind, canon))
        role, word = next(words)
        last = a
        for run in _RUN.finditer(text, a, b):
            if word is not None and run[0].lower() == word.partition(":")[2 if role == "given" else 0]:
                out += [text[last : run.start()], new(role, word, run[0])]
                last = run.end()
                role, word = next(words, ("", None))
        out.append(text[last:b])
    return "".join([*out, text[at:]]), n


def _entities(with_doc: bool):
    """Distinct entities of a batch, by document if asked; without, a row of
    kind "" for each document that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = [x for _, _, kind, canon in detect(text.as_py()) for x in entities_of(kind, canon)]
                rows.update((doc if with_doc else 0, *x) for x in own if x[0] != "initial")
                if own and not with_doc:
                    rows.add((doc, "", ""))
            doc, kind, canon = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(kind, pa.string()), pa.array(canon, pa.string())], ["doc", "kind", "canon"])

    return run


def _proposals(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [surrogate(key, *x) for x in zip(*(batch.column(c).to_pylist() for c in ("kind", "canon", "attempt")), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], [*batch.schema.names, "new"])

    return run


def resolve(entities: DataFrame, key: bytes, scratch: common.Scratch, rounds: int = 100) -> DataFrame:
    """(kind, canon, attempt, new) with distinct surrogates, none of which is
    an entity of the corpus. ``entities`` has distinct (kind, canon)."""
    kind = "kind string, canon string, attempt int, new string"
    propose = lambda df: df.mapInArrow(common.tidy(_proposals(key)), kind)
    bare = F.when(F.col("kind") == "given", F.substring_index("canon", ":", -1)).otherwise(F.col("canon"))
    real = scratch.keep(entities.select("kind", bare.alias("new")).distinct(), "real")
    now = scratch.keep(propose(entities.withColumn("attempt", F.lit(0))), "round-0")
    for k in range(1, rounds + 1):
        first = now.groupBy("kind", "new").agg(F.min_by("canon", F.struct("attempt", "canon")).alias("first"), F.count("*").alias("n"))
        clash = first.filter("n > 1").join(real, ["kind", "new"], "left_anti").select("kind", "new", "first")
        taken = now.join(real, ["kind", "new"], "left_semi").select("kind", "canon")
        losers = now.join(clash, ["kind", "new"]).filter("canon <> first").select("kind", "canon").union(taken).distinct()
        losers = scratch.keep(losers, f"losers-{k}")
        if losers.isEmpty():
            scratch.drop("real", f"losers-{k}")
            return now
        again = now.join(losers.withColumn("lost", F.lit(True)), ["kind", "canon"], "left")
        stay = again.filter("lost is null").select("kind", "canon", "attempt", "new")
        new = propose(again.filter("lost").select("kind", "canon", (F.col("attempt") + 1).alias("attempt")))
        now = scratch.keep(stay.unionByName(new), f"round-{k}")
        scratch.drop(f"round-{k - 1}", f"losers-{k}")
    raise RuntimeError("surrogates still collide; the entities outnumber their formats")


def _rewritten(key: bytes, retries: dict[tuple[str, str], int] | None, sketch: np.ndarray):
    """(fl_row, fl_text, fl_mark[, fl_again]) to fl_row and the results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            again = batch.column(3) if retries is None else [None] * batch.num_rows
            none = dict.fromkeys(KINDS, 0)
            for text, hit, own in zip(batch.column(1), common.hits(sketch, batch.column(2).to_numpy()).tolist(), again, strict=True):
                if not hit or not text.is_valid:
                    texts.append(text.as_py())
                    counts.append(none)
                    continue
                known = retries if retries is not None else {(x["kind"], x["canon"]): x["attempt"] for x in own.as_py() or ()}
                new, n = rewrite(text.as_py(), key, known)
                texts.append(new)
                counts.append(n)
            cols = [batch.column(0), pa.array(texts, pa.string()), *(pa.array([n[kind] for n in counts], pa.int64()) for kind in KINDS)]
            yield pa.RecordBatch.from_arrays(cols, ["fl_row", "fl_clean", *(f"fl_{kind}" for kind in KINDS)])

    return run


def pseudonymise(docs: DataFrame, key: str, *, carry: list[str] | None = None, most_retries: int = 100_000) -> DataFrame:
    """The ``carry`` columns (doc_id if not given) with fl_clean, the text in
    which surrogates stand for entities, and fl_<kind>, how many mentions there
    were."""
    if not key:
        raise ValueError("a key is needed")
    scratch = common.Scratch(docs.sparkSession, "pii")
    secret = key.encode()
    carry = ["doc_id"] if carry is None else carry
    rows = docs.select(common.key_of("doc_id").alias("doc"), F.col("text").cast("string").alias("text"))
    found = scratch.keep(rows.mapInArrow(common.tidy(_entities(False)), "doc long, kind string, canon string"), "found")
    sketch = common.marks(found.filter("kind = ''"), "doc")
    entities = scratch.keep(found.filter("kind <> ''").select("kind", "canon").distinct(), "entities")
    again = resolve(entities, secret, scratch).filter("attempt > 0").select("kind", "canon", "attempt")
    scratch.drop("found", "entities")
    few = again.limit(most_retries + 1).collect()
    whole = docs.select(common.carried(carry), F.col("text").cast("string").alias("fl_text"), common.key_of("doc_id").alias("fl_doc"))
    whole = whole.withColumn("fl_mark", common.mark("fl_doc"))
    results = ["fl_clean", *(f"fl_{k}" for k in KINDS)]
    kind = f"fl_row {common.carried_kind(docs, carry)}, fl_clean string, " + ", ".join(f"fl_{k} long" for k in KINDS)
    if len(few) <= most_retries:
        out = whole.select("fl_row", "fl_text", "fl_mark").mapInArrow(common.tidy(_rewritten(secret, {(r[0], r[1]): r[2] for r in few}, sketch)), kind)
        return out.select(*common.spread(carry, results))
    held = rows.mapInArrow(common.tidy(_entities(True)), "doc long, kind string, canon string").join(again, ["kind", "canon"])
    held = held.groupBy("doc").agg(F.collect_set(F.struct("kind", "canon", "attempt")).alias("fl_again"))
    out = whole.join(held, F.col("fl_doc") == held["doc"], "left").select("fl_row", "fl_text", "fl_mark", "fl_again")
    return out.mapInArrow(common.tidy(_rewritten(secret, None, sketch)), kind).select(*common.spread(carry, results))
