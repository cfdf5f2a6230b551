"""Personal data replaced by surrogates of the same type and format.

A surrogate is a keyed permutation of what can be written in the entity's format: the letters of an
address, the digits of a number, the names of a list. A permutation keeps different entities
different and equal ones equal, in all documents, without a table of all entities; it is conjugated
with a shift, so nothing is its own surrogate. The corpus is still checked for collisions, and a
key version with one is given up for the next.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
import secrets
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import sent, small, stage, texts

#: The setting that holds the key. Who knows it can turn surrogates back, so it is kept elsewhere.
KEY_SETTING = "spark.rallymart.surrogateKey"
ROUNDS = 8
MOST_VERSIONS = 16
#: Letters that are one number together.
MOST_AT_ONCE = 512

# Names for persons, by gender and script (fixed values).
FIRST_NAMES = {
    ("f", "latin"): "anna clara elena emma helen jane julia laura lucy maria martha nora olga rosa sarah sofia".split(),
    ("m", "latin"): "adam carl david erik felix george henry jacob john martin oscar paul peter robert simon thomas".split(),
    ("f", "cyrillic"): "анна вера галина дарья елена ирина мария нина ольга софья татьяна юлия".split(),
    ("m", "cyrillic"): "андрей борис виктор глеб иван кирилл максим олег пётр сергей степан юрий".split(),
}
# Forms of address and the gender they tell (fixed values).
TITLES = {
    "mr": "m", "mister": "m", "herr": "m", "monsieur": "m", "señor": "m", "господин": "m", "г-н": "m",
    "mrs": "f", "ms": "f", "frau": "f", "madame": "f", "mademoiselle": "f", "señora": "f",
    "госпожа": "f", "г-жа": "f", "dr": "", "prof": "",
}
#: Letters that stand for each other, lower case.
ALPHABETS = (
    "aeiouy", "bcdfghjklmnpqrstvwxz", "áéíóúàèìòùâêîôûäëïöü", "çñßšžčł",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ",
)

_DIGIT = re.compile(r"\d")
_GROUP = re.compile(r"\d+")
_DOMAIN = re.compile(r"(?:(?:[^\W_]|-)+\.)+[^\W\d_]{2,}(?![\w-])")
_PHONE = re.compile(
    r"(?<![\w.+-])(?:(\+\d{1,3})[ .-]?)?(\(\d{3}\) ?|\d{3}[ .-])(\d{3})([ .-])(\d{4})(?![\w-])"
)
#: Numbers with a country code: eleven digits behind +1, eight to fifteen behind the others.
_ABROAD = re.compile(r"(?<![\w+.-])\+(?:1(?:[ ./-]?\(?\d\)?){10}|[2-9](?:[ ./-]?\(?\d\)?){7,14})(?![\w-])")
#: Country codes of two digits (fixed values); 1 and 7 stand alone, all others have three.
_TWO_DIGITS = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98".split()
)
_IP6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])")
_IP = re.compile(r"(?<![\w.])(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?!\w|\.\d)")
#: Groups of digits with a blank or hyphen between; a card number is made of whole groups.
_DIGITS = re.compile(r"(?<!\w)(?<!\d\.)\d++(?!\w)(?:[ -]\d++(?!\w))*+")
_CARD_LENGTHS = range(19, 12, -1)
_SSN = re.compile(r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){8,31}+")
_IBAN_FORM = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
#: What stands behind the name of a secret; without a digit only behind a word for a password.
_VALUE = r"[\"']?([^\s\"',;<>]{7,}[^\s\"',;<>.!?)\]}])"
_SECRET = re.compile(
    r"(?<![A-Za-z])(?:(password|passwd|pwd|passphrase|api[ _-]?key)|token|secret)\s{0,3}[=:]\s{0,3}" + _VALUE, re.I
)
_BEARER = re.compile(r"(?<![A-Za-z])Bearer\s{1,3}([\w.~+/=-]{7,}[\w~+/=-])")
_ACCESS_KEY = re.compile(r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")
_PERSON = re.compile(
    rf"(?<![\w-])({'|'.join(sorted(TITLES, key=len, reverse=True))})(?:\.|(?<=\w))\s{{1,3}}"
    r"((?:[^\W\d_]\.|[^\W\d_]+(?:['’-][^\W\d_]+)*)(?: (?:[^\W\d_]\.|[^\W\d_]+(?:['’-][^\W\d_]+)*))*)",
    re.I,
)
_MARKS = frozenset("._%+-'")


def _luhn(digits: str) -> int:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10


def _mod97(iban: str) -> int:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def _cards(text: str, other: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Card numbers: whole groups of digits, 19 down to 13 of them, with a valid check digit.

    Of those that overlap, one in groups as on cards (none but the last under four digits) goes
    before others, then the earlier, then the longer one. None starts within an `other` entity.
    """
    can = []
    for run in _DIGITS.finditer(text):
        if run.end() - run.start() < _CARD_LENGTHS[-1]:
            continue
        groups = [(m.start(), m.end()) for m in _GROUP.finditer(text, run.start(), run.end())]
        for i, (start, _) in enumerate(groups):
            digits, proper = "", True
            for own, end in groups[i:]:
                proper &= not digits or last >= 4
                last = end - own
                digits += text[own:end]
                if len(digits) > _CARD_LENGTHS[0]:
                    break
                if len(digits) in _CARD_LENGTHS and _luhn(digits) == 0:
                    can.append((not proper, start, -end))
    if not can:
        return []
    taken = {at for start, end, _ in other for at in range(start, end)}
    found = []
    for _, start, end in sorted(can):
        if start not in taken:
            own = range(start, -end)
            if taken.isdisjoint(own) or not any(a < -end and start < b for a, b in found):
                found.append((start, -end))
                taken.update(own)
    return found


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers: from each start, the longest that ends where a word does and has its check digits."""
    at = 0
    while m := _IBAN.search(text, at):
        at = m.start() + 1
        for end in range(m.end(), m.start() + 11, -1):
            if end < len(text) and (text[end].isalnum() or text[end] == "_"):
                continue
            if _IBAN_FORM.fullmatch(own := text[m.start() : end]) and _mod97(own.replace(" ", "")) == 1:
                yield m.start(), end
                at = end
                break


def _ip6(text: str) -> int:
    """The address as a number; 0 for what is none, and for those that name no host of anyone."""
    try:
        value = int(ipaddress.IPv6Address(text))
    except ValueError:
        return 0
    return value if value >= 2**32 else 0


def _country(digits: str) -> int:
    """How many digits of a number with a plus are its country code."""
    return 1 if digits[0] in "17" else 2 if digits[:2] in _TWO_DIGITS else 3


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the entities, in order and without overlaps; the earlier kind wins.

    Addresses are found from their @, numbers only in texts with a digit, so long texts and long
    words cost time in proportion to their length.
    """
    found: list[tuple[int, int, str]] = []
    at = text.find("@")
    while at >= 0:
        start = at
        # An earlier @ ends the run, so each character is looked at once.
        while start > 0 and (text[start - 1].isalnum() or text[start - 1] in _MARKS):
            start -= 1
        while start < at and text[start] in _MARKS:
            start += 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            found.append((start, domain.end(), "email"))
        at = text.find("@", at + 1)
    found += [(m.start(2), m.end(2), "secret") for m in _SECRET.finditer(text) if m[1] or _DIGIT.search(m[2])]
    found += [(m.start(1), m.end(1), "secret") for m in _BEARER.finditer(text)]
    if "::" in text or _DIGIT.search(text):
        found += [(m.start(), m.end(), "ip") for m in _IP6.finditer(text) if _ip6(m[0])]
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), "secret") for m in _ACCESS_KEY.finditer(text)]
        found += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text)]
        if "+" in text:
            found += [(m.start(), m.end(), "phone") for m in _ABROAD.finditer(text)]
        found += [
            (m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(int(n) < 256 for n in m.groups())
        ]
        found += [(start, end, "iban") for start, end in _ibans(text)]
        found += [(m.start(), m.end(), "ssn") for m in _SSN.finditer(text)]
        other = [x for x in found if x[2] in ("phone", "ssn")]
        found += [(start, end, "card") for start, end in _cards(text, other)]
    for m in _PERSON.finditer(text):
        words = m[2].split(" ")
        kept = next((i for i, w in enumerate(words) if not w[0].isupper()), len(words))
        if kept:
            found.append((m.start(), m.start(2) + len(" ".join(words[:kept])), "person"))
    chosen: list[tuple[int, int, str]] = []
    for span in sorted(found, key=lambda s: (s[0], -s[1])):
        if not chosen or span[0] >= chosen[-1][1]:
            chosen.append(span)
    return chosen


class Surrogates:
    """Surrogates under a key; `normal` is what makes two spellings the same entity."""

    def __init__(self, key: bytes, version: int = 0) -> None:
        self.key = hashlib.blake2b(version.to_bytes(4, "big"), key=key[:64], digest_size=32).digest()
        self.permuted = lru_cache(10_000)(self._permuted)

    def _feistel(self, value: int, bits: int, tweak: bytes, back: bool) -> int:
        half = (bits + 1) // 2
        mask = (1 << half) - 1
        left, right = value >> half, value & mask
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            held = left if back else right
            said = b"%d|%d|%s|%s" % (i, bits, held.to_bytes(half // 8 + 1, "big"), tweak)
            mixed = hashlib.blake2b(said, key=self.key, digest_size=64).digest()
            while 8 * len(mixed) < half:
                mixed += hashlib.blake2b(mixed, key=self.key, digest_size=64).digest()
            round_ = int.from_bytes(mixed, "big") & mask
            left, right = (right ^ round_, left) if back else (right, left ^ round_)
        return left << half | right

    def _permuted(self, value: int, size: int, tweak: bytes) -> int:
        """A permutation of range(size) without fixed points (size of 2 or more)."""
        bits = max(2, (size - 1).bit_length() + (size - 1).bit_length() % 2)

        def walk(x: int, back: bool) -> int:
            while True:
                x = self._feistel(x, bits, tweak, back)
                if x < size:
                    return x

        return walk((walk(value, False) + max(1, size // 3)) % size, True)

    def letters(self, text: str, tweak: str, alphabets: tuple[str, ...]) -> str:
        """Each letter replaced by one of its alphabet, all together as one number; case stays.

        Parts of `MOST_AT_ONCE` letters each, so a long text costs time in proportion to its length.
        """
        if len(text) > MOST_AT_ONCE:
            parts = range(0, len(text), MOST_AT_ONCE)
            return "".join(self.letters(text[i : i + MOST_AT_ONCE], f"{tweak}+{i}", alphabets) for i in parts)
        low = text.lower() if len(text.lower()) == len(text) else text
        kinds = [next((a for a in alphabets if c in a), "") for c in low]
        size = math.prod(len(a) for a in kinds if a)
        if size < 2:
            return text
        value = 0
        for c, a in zip(low, kinds, strict=True):
            if a:
                value = value * len(a) + a.index(c)
        form = tweak + "".join(a[0] if a else c for c, a in zip(low, kinds, strict=True))
        value = self.permuted(value, size, form.encode())
        out = []
        for c, a in zip(reversed(text), reversed(kinds), strict=True):
            if a:
                value, place = divmod(value, len(a))
                out.append(a[place].upper() if c.isupper() else a[place])
            else:
                out.append(c)
        return "".join(reversed(out))

    def email(self, text: str) -> str:
        local, _, domain = text.partition("@")
        plain = ("abcdefghijklmnopqrstuvwxyz", "0123456789", *ALPHABETS[2:])
        *labels, top = domain.split(".")
        # Names that are reserved for examples stay.
        labels = [x if x.lower() == "example" else self.letters(x, "domain", plain) for x in labels]
        new = self.letters(local, "local@" + domain.lower(), plain)
        if new == local:  # no letter of the alphabets
            new = self._invented(local.lower() + "@" + domain.lower())
        return f"{new}@{'.'.join([*labels, top])}"

    def phone(self, text: str) -> str:
        """All spellings of a number get the same digits; a country code stays."""
        digits = re.sub(r"\D", "", text)
        code = _country(digits) if text.startswith("+") else 0
        country, own = digits[:code], digits[code:]
        if len(own) == 10 and country in ("", "1"):
            new = self._north_american(own, country)
        else:
            new = self.letters(own, f"phone+{country}", ("0123456789",))
        it = iter(country + new)
        return "".join(next(it) if c.isdigit() else c for c in text)

    def _north_american(self, digits: str, country: str) -> str:
        if digits[3:6] == "555":  # the exchange of invented numbers
            new = self.letters(digits[:3] + digits[6:], f"555{country}", ("0123456789",))
            return new[:3] + "555" + new[3:]
        size = 10**10 - 10**7

        # All numbers whose exchange is not 555, in order.
        def order(n: int) -> int:
            block, rest = divmod(n, 10**7)
            return block * (10**7 - 10**4) + rest - (10**4 if rest >= 556 * 10**4 else 0)

        value = self.permuted(order(int(digits)), size, f"phone{country}".encode())
        block, rest = divmod(value, 10**7 - 10**4)
        return f"{block * 10**7 + rest + (10**4 if rest >= 555 * 10**4 else 0):010d}"

    def ip(self, text: str) -> str:
        if ":" in text:
            # All addresses above those that are left alone.
            value = self.permuted(_ip6(text) - 2**32, 2**128 - 2**32, b"ip6") + 2**32
            return str(ipaddress.IPv6Address(value))
        value = 0
        for part in text.split("."):
            value = value * 256 + int(part)
        value = self.permuted(value, 2**32, b"ip")
        return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))

    def card(self, text: str) -> str:
        digits = re.sub(r"\D", "", text)
        new = self.letters(digits[:-1], "card", ("0123456789",))
        new += str(-_luhn(new + "0") % 10)
        it = iter(new)
        return "".join(next(it) if c.isdigit() else c for c in text)

    def ssn(self, text: str) -> str:
        return self.letters(text, "ssn", ("0123456789",))

    def iban(self, text: str) -> str:
        plain = text.replace(" ", "")
        body = self.letters(plain[4:], "iban" + plain[:2], ("abcdefghijklmnopqrstuvwxyz", "0123456789"))
        new = f"{plain[:2]}{98 - _mod97(plain[:2] + '00' + body):02d}{body}"
        it = iter(new)
        return "".join(c if c == " " else next(it) for c in text)

    def secret(self, text: str) -> str:
        if text.startswith("AKIA") and len(text) == 20:
            return "AKIA" + self.secret(text[4:])
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
            return self.letters(text, "hex", ("0123456789abcdef",))
        return self.letters(text, "secret", ("abcdefghijklmnopqrstuvwxyz", "0123456789"))

    def person(self, text: str) -> str:
        match = _PERSON.fullmatch(text)
        gender = TITLES[match[1].lower()]
        first, *rest = match[2].split(" ")
        words = [*([self._first(first, gender)] if rest else []), *(self._last(w) for w in rest or [first])]
        return text[: match.start(2)] + " ".join(words)

    def _first(self, name: str, gender: str) -> str:
        script = "cyrillic" if "а" <= name[0].lower() <= "я" else "latin"
        for (g, s), names in FIRST_NAMES.items():
            if s == script and name.lower() in names and gender in ("", g):
                new = names[self.permuted(names.index(name.lower()), len(names), f"{g}{s}".encode())]
                return new.title() if not name.isupper() else new.upper()
        listed = {n for names in FIRST_NAMES.values() for n in names}
        new = self._last(name)
        while new.lower() in listed:  # names that are not on the lists stay off them
            new = self._last(new)
        return new

    def _last(self, name: str) -> str:
        new = self.letters(name, "name", ALPHABETS)
        return self._invented(name).title() if new == name else new

    def _invented(self, own: str) -> str:
        """A pronounceable word from a keyed hash, for what has no letter of the alphabets."""
        n = int.from_bytes(hashlib.blake2b(own.encode(), key=self.key, digest_size=12).digest(), "big")
        letters = (ALPHABETS[(i + 1) % 2] for i in range(12))
        return "".join(a[(n >> 8 * i & 255) % len(a)] for i, a in enumerate(letters))

    def of(self, kind: str, text: str) -> str:
        return getattr(self, kind)(text)


def normal(kind: str, text: str) -> str:
    """The same for all spellings of an entity."""
    if kind == "phone":
        return ("+" if text.startswith("+") else "") + re.sub(r"\D", "", text)
    if kind == "card":
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "ip":
        return str(_ip6(text)) if ":" in text else ".".join(str(int(n)) for n in text.split("."))
    return text if kind == "secret" else text.lower()


def replaced(text: str, surrogates: Surrogates) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with surrogates, and kind, start and end of each in it (in code points)."""
    parts, spans, last, length = [], [], 0, 0
    for start, end, kind in find_entities(text):
        new = surrogates.of(kind, text[start:end])
        parts += [text[last:start], new]
        length += start - last
        spans.append((kind, length, length + len(new)))
        length += len(new)
        last = end
    return ("".join([*parts, text[last:]]), spans) if parts else (text, [])


def entities(docs: DataFrame, version: int, key: bytes) -> DataFrame:
    """All different entities of the texts: kind, and hashes of entity and surrogate.

    Only keyed hashes of both leave the task; each partition sends an entity once per batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key, version)

        def hashed(kind: str, text: str) -> str:
            said = normal(kind, text).encode()
            return hashlib.blake2b(said, key=surrogates.key, digest_size=16).hexdigest()

        for batch in small(batches):
            seen = {}
            for text in texts(batch, "text"):
                for start, end, kind in find_entities(text):
                    own = text[start:end]
                    if (kind, own) not in seen:
                        seen[kind, own] = hashed(kind, own), hashed(kind, surrogates.of(kind, own))
            rows = list(zip(*((k, a, b) for (k, _), (a, b) in seen.items()), strict=True)) or [(), (), ()]
            yield pa.record_batch([pa.array(c, pa.string()) for c in rows], names=["kind", "entity", "surrogate"])

    schema = "kind string, entity string, surrogate string"
    return docs.select("text").mapInArrow(run, schema).distinct()


def collisions(found: DataFrame) -> DataFrame:
    """Surrogates that two entities share, or one entity has two of, or that are the entity itself."""
    shared = found.groupBy("kind", "surrogate").count().where("count > 1").select("kind", "surrogate")
    split = found.groupBy("kind", "entity").count().where("count > 1").select("kind", "entity")
    own = found.where("entity = surrogate").select("kind", "entity")
    return shared.union(split).union(own)


_own_keys: dict[str, bytes] = {}


def key_of(spark: SparkSession) -> bytes:
    """The key of the session's setting, else a random one that the application keeps.

    Without the setting surrogates are the same in all jobs of one application only.
    """
    given = spark.conf.get(KEY_SETTING, None)
    if given:
        return given.encode()
    return _own_keys.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def replace(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """`docs` with surrogates in `text`, and `entities`: kind, start and end of each.

    The key is that of `key_of` if none is given.

    A column `entities` of the input is replaced; other columns stay. Null texts stay null, texts
    without entities stay as they are. Key versions are tried until the whole corpus has no
    collision, so the check reads the texts once more.
    """
    key = key or key_of(docs.sparkSession)
    for version in range(MOST_VERSIONS):
        found = stage(entities(docs, version, key), "entities")
        if collisions(found).isEmpty():
            break
    else:
        raise ValueError("no key version without collisions; use another key")
    docs = docs.drop("entities")
    spans = T._parse_datatype_string("entities array<struct<kind string, start int, end int>>")
    schema = T.StructType([*docs.schema.fields, *spans.fields])
    shared: Callable = sent(docs.sparkSession, (key, version))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        surrogates = Surrogates(*shared())
        kind = to_arrow_type(spans.fields[0].dataType)
        for batch in small(batches):
            made = [(None, []) if t is None else replaced(t, surrogates) for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in made], columns[at].type)
            names = ("kind", "start", "end")
            listed = pa.array([[dict(zip(names, s, strict=True)) for s in x] for _, x in made], kind)
            yield pa.RecordBatch.from_arrays([*columns, listed], names=[*batch.schema.names, "entities"])

    return docs.mapInArrow(run, schema)
