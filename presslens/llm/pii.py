"""Surrogates for personal data: keyed, type-consistent, one to one.

Detected entities are replaced by surrogates of the same type and format. Every
surrogate comes from a keyed permutation (a Feistel network with cycle walking)
of the values of the entity's own shape, so within a shape two entities can't
meet in one surrogate, equal entities have equal surrogates wherever they occur,
and no table of entities has to be held or shuffled. A check counts, over all
documents, surrogates that stand for more than one entity.

====== ======================================= =======================================
type   found                                   surrogate
====== ======================================= =======================================
email  local@host                              local part and first host label keep
                                               their letters, digits and marks by kind
phone  + or (, 10 to 15 digits with marks      punctuation, country code and, for NANP
                                               numbers, validity stay
card   13 to 19 digits, spaced or not          first digit and Luhn state stay
ip     four numbers up to 255                  private stays private, public public
ssn    3-2-4 digits with hyphens               all nine digits permuted
iban   two letters, check digits, 11 to 30     country stays, check digits are right
                                               exactly where they were
name   title or known given name, surname      gender and script of the given name,
                                               script and letter kinds of the surname
====== ======================================= =======================================

Coreference: letter case of an email, marks in a phone or card number and the
presence of a title don't change the entity; a surname alone after a title gets
the surrogate it has in a full name.

What happens in special cases:

* a null text stays null, an empty text stays empty, a text without entities
  stays as it is; texts are searched whole;
* where two types fit, the earlier start and then the order of the pattern
  decides, and a name never overlaps another type;
* an entity never is its own surrogate, unless no character of it can change (a
  local part of marks alone);
* equal rows are treated alike; ``entities, n_entities`` are added and replace
  input columns of these names; all other columns stay.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Given names by script and gender; each list is permuted within itself.
GIVEN = {
    ("latin", "f"): ("Alice", "Amelia", "Ana", "Anna", "Camille", "Carmen", "Charlotte", "Chloe", "Clara", "Elena", "Elizabeth", "Emily", "Emma", "Eva", "Greta", "Hannah", "Ines", "Isabel", "Jane", "Jennifer", "Julia", "Karin", "Laura", "Lena", "Linda", "Lucia", "Maria", "Marie", "Mary", "Monika", "Olivia", "Patricia", "Paula", "Petra", "Sabine", "Sarah", "Sofia", "Sophie", "Susan", "Teresa"),
    ("latin", "m"): ("Adam", "Alejandro", "Andreas", "Antonio", "Carlos", "Charles", "Daniel", "David", "Diego", "Felix", "Fernando", "François", "George", "Hans", "Henri", "Jack", "Jacques", "James", "Javier", "Jean", "John", "Jorge", "Jose", "Juan", "Klaus", "Lukas", "Luis", "Michael", "Miguel", "Oliver", "Paul", "Pedro", "Peter", "Pierre", "Robert", "Stefan", "Thomas", "Tobias", "William", "Wolfgang"),
    ("cyrillic", "f"): ("Айгуль", "Александра", "Алина", "Анастасия", "Анна", "Валентина", "Вера", "Виктория", "Галина", "Дарья", "Екатерина", "Елена", "Ирина", "Ксения", "Людмила", "Мария", "Наталья", "Ольга", "Светлана", "Татьяна"),
    ("cyrillic", "m"): ("Александр", "Алексей", "Андрей", "Антон", "Борис", "Виктор", "Владимир", "Григорий", "Дмитрий", "Евгений", "Иван", "Игорь", "Константин", "Максим", "Михаил", "Николай", "Олег", "Павел", "Сергей", "Юрий"),
}
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Señor", "Señora", "Sr", "Sra", "Monsieur", "Madame", "Mme", "Mlle", "г-н", "г-жа", "господин", "госпожа")
KINDS = ("email", "phone", "card", "ip", "ssn", "iban", "name")
_GIVEN = {name: (group, i) for group, names in GIVEN.items() for i, name in enumerate(names)}
_WORD = r"(?:\p{Lu}['’])?\p{Lu}[\p{Ll}]+(?:\p{Lu}\p{Ll}+)?(?:[-'’]\p{Lu}[\p{Ll}]+)?"
MARKS = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+%-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]*\d))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}\b)"
    r"|(?P<card>(?<![\w+])(?:\d[ -]?){12,18}\d(?![\d-]*\d)(?!\w))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\d{1,4}(?:[ ./-]\d{2,8}){1,5}(?!\w)"
    r"|(?<![\w+/.-])0\d{2,4}/\d{5,8}(?![\w/])|(?<![\w+/.-])(?:[2-9]\d{2}[2-9]\d{6}|0[1-9]\d{8,9})(?![\w/]|[.-]\d)"
    r"|(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])(?:\d{2,4}[ .-]?){1,3}\d{2,4}(?!\w)|(?<![\w+])\+\d{10,15}(?!\w))"
)
NAME = regex.compile(
    rf"\b(?:(?:{'|'.join(TITLES)})\.? )(?:{_WORD} ){{0,2}}{_WORD}\b"
    rf"|\b(?:{'|'.join(n for names in GIVEN.values() for n in names)}) (?:{_WORD})\b"
)
#: A name needs one of these words, everything else a digit or an @; other texts are passed over quickly.
_CAPITAL = re.compile(r"[A-ZÀ-ÞА-Я][^\W\d_]+")
_DIGIT = re.compile(r"[0-9]")
#: A date, with or without a time behind it.
_DATE = re.compile(r"(?:(?:19|20)\d{2}[-./ ](?:0?[1-9]|1[0-2])[-./ ](?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-./ ](?:0?[1-9]|1[0-2])[-./ ](?:19|20)\d{2})(?![\d-])")
_STARTS = {n for names in GIVEN.values() for n in names} | {t for t in TITLES if t[0].isupper()}
_LOWER_TITLES = tuple(t for t in TITLES if t[0].islower())
ENTITY = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("entity", T.StringType()), T.StructField("surrogate", T.StringType())]))
#: Kinds of characters that stand in for each other.
ALPHABETS = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áàâäéèêëíìîïóòôöúùûü", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ")


def _round(key: str, tweak: str, i: int, value: int) -> int:
    return int.from_bytes(hmac.digest(key.encode(), f"{tweak}|{i}|{value}".encode(), "sha256"), "big")


def permute(value: int, size: int, tweak: str, key: str) -> int:
    """A keyed permutation of 0 .. size - 1: Feistel over a product of two factors, walked until it falls inside."""
    if size < 2:
        return value
    a = 1 << (size - 1).bit_length() // 2
    b = -(-size // a)
    # To a keyed place, one further, and back: one cycle of all values, so none stays where it is.
    for back in (False, True):
        while True:
            left, right = divmod(value, b)
            for i in range(4):  # left in a, right in b
                if back:
                    right = (right - _round(key, tweak, 7 - 2 * i, left)) % b
                    left = (left - _round(key, tweak, 6 - 2 * i, right)) % a
                else:
                    left = (left + _round(key, tweak, 2 * i, right)) % a
                    right = (right + _round(key, tweak, 2 * i + 1, left)) % b
            value = left * b + right
            if value < size:
                break
        value = value if back else (value + 1) % size
    return value


@lru_cache(1000)
def _letters(block: int, cased: bool) -> str:
    """Letters of 128 code points that are in none of ALPHABETS, with or without a capital of one character."""
    found = (chr(i) for i in range(block * 128, block * 128 + 128))
    return "".join(c for c in found if c.isalpha() and c.lower() == c and _cased(c) == cased and not any(c in x for x in ALPHABETS))


def _cased(c: str) -> bool:
    return len(c.upper()) == 1 and c.upper() != c and c.upper().lower() == c


def _group(c: str) -> str:
    """The characters that stand in for one; empty if it stays."""
    return next((x for x in ALPHABETS if c in x), "") or (_letters(ord(c) // 128, _cased(c)) if c.isalpha() else "")


def _alike(text: str, tweak: str, key: str) -> str:
    """Permute a string among those with the same kinds of characters at the same places; case stays."""
    low = [c.lower() if len(c.lower()) == 1 and _cased(c.lower()) else c for c in text]
    kinds = [_group(c) for c in low]
    size, value = 1, 0
    for c, k in zip(low, kinds, strict=True):
        if c in k:
            size *= len(k)
            value = value * len(k) + k.index(c)
    shape = "".join(k[0] if c in k else c for c, k in zip(low, kinds, strict=True))
    value = permute(value, size, f"{tweak}|{shape}", key)
    out = list(text)
    for i in range(len(text) - 1, -1, -1):
        if low[i] in kinds[i]:
            value, at = divmod(value, len(kinds[i]))
            c = kinds[i][at]
            out[i] = c.upper() if text[i] != low[i] else c
    return "".join(out)


def luhn(body: str) -> int:
    """The check digit of the digits before it."""
    doubled = [int(d) for d in reversed(body)]
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(doubled))
    return -total % 10


def _refill(text: str, digits: str) -> str:
    put = iter(digits)
    return "".join(next(put) if c.isdigit() else c for c in text)


def _nanp(d: str) -> bool:
    return d[0] not in "01" and d[3] not in "01"


def _email(text: str, key: str) -> str:
    local, _, host = text.lower().rpartition("@")
    first, dot, rest = host.partition(".")
    # The fixed rest of the host is part of the tweak: hosts that differ there differ anyway.
    return _alike(local, f"email|{host}", key) + "@" + _alike(first, "host", key) + dot + rest


#: Country codes of two digits; 1 and 7 stand alone, all others have three (fixed values).
TWO_DIGIT_CODES = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()


def phone_parts(text: str) -> tuple[str, str, str]:
    """Country code (of numbers that start with a plus), trunk zeros, and the subscriber's digits."""
    bare = text.replace("(0)", "") if text.startswith("+") else text
    digits = "".join(c for c in bare if c.isdigit())
    country = ""
    if text.startswith("+"):
        country = digits[: 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_CODES else 3]
    own = digits[len(country) :]
    trunk = "" if country else own[: len(own) - len(own.lstrip("0"))]
    return country, trunk, own[len(trunk) :]


def _phone(text: str, key: str) -> str:
    country, trunk, own = phone_parts(text)
    if not own:
        return text
    value = int(own)
    while True:
        value = permute(value, 10 ** len(own), f"phone|{country}|{trunk}|{len(own)}", key)
        new = str(value).zfill(len(own))
        if (len(own) != 10 or _nanp(new) == _nanp(own)) and (country or not new.startswith("0")):
            break
    head, zero, tail = text.partition("(0)") if country else ("", "", text)
    if not zero:
        return _refill(text, country + trunk + new)
    held = sum(c.isdigit() for c in head)
    return _refill(head, (country + new)[:held]) + zero + _refill(tail, (country + new)[held:])


def _card(text: str, key: str) -> str:
    digits = "".join(c for c in text if c.isdigit())
    body = digits[0] + str(permute(int(digits[1:-1]), 10 ** (len(digits) - 2), f"card|{digits[0]}|{len(digits)}", key)).zfill(len(digits) - 2)
    off = (int(digits[-1]) - luhn(digits[:-1])) % 10
    return _refill(text, body + str((luhn(body) + off) % 10))


def _ip_class(n: int) -> int:
    a, b = n >> 24, n >> 16 & 255
    return 0 if a == 10 or a == 172 and 16 <= b < 32 or a == 192 and b == 168 else 1 if a in (0, 127) or a >= 224 else 2


def _ip(text: str, key: str) -> str:
    a, b, c, d = map(int, text.split("."))
    start = value = a << 24 | b << 16 | c << 8 | d
    while True:
        value = permute(value, 1 << 32, "ip", key)
        if _ip_class(value) == _ip_class(start):
            return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def _ssn(text: str, key: str) -> str:
    return _refill(text, str(permute(int(text.replace("-", "")), 10**9, "ssn", key)).zfill(9))


def _iban_check(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


def _iban(text: str, key: str) -> str:
    plain = text.replace(" ", "")
    country, check, rest = plain[:2], int(plain[2:4]), plain[4:]
    new = _alike(rest, f"iban|{country}", key)
    moved = (check - _iban_check(country, rest)) % 97 if check < 98 else None
    # Right check digits stay right; wrong ones stay as far off as they were.
    digits = plain[2:4] if moved is None else str((_iban_check(country, new) + moved - 2) % 97 + 2).zfill(2)
    put = iter(country + digits + new)
    return "".join(c if c == " " else next(put) for c in text)


def _name(text: str, key: str) -> str:
    out = []
    for part in text.split(" "):
        bare = part.rstrip(".")
        if bare in TITLES:
            out.append(part)
        elif part in _GIVEN:
            group, i = _GIVEN[part]
            out.append(GIVEN[group][permute(i, len(GIVEN[group]), "|".join(group), key)])
        else:
            new = _alike(part, "surname", key)
            while new in _GIVEN or new.rstrip(".") in TITLES:
                new = _alike(new, "surname", key)
            out.append(new)
    return " ".join(out)


_MAKE = {"email": _email, "phone": _phone, "card": _card, "ip": _ip, "ssn": _ssn, "iban": _iban, "name": _name}


@lru_cache(100_000)
def surrogate(kind: str, text: str, key: str) -> str:
    return _MAKE[kind](text, key)


def identity(kind: str, text: str) -> str:
    """What makes mentions the same entity, or surrogates the same surrogate."""
    if kind == "phone":
        country, trunk, own = phone_parts(text)
        return f"+{country}{own}" if country else trunk + own
    if kind in ("card", "ssn"):
        return "".join(c for c in text if c.isdigit())
    if kind == "name":
        return " ".join(p for p in text.split(" ") if p.rstrip(".") not in TITLES)
    return text.lower().replace(" ", "")


def _counts(kind: str, said: str) -> bool:
    """Whether a mark's digits make it one: phones have 10 to 15 and aren't dates, cards have 15 or 16, or a right check digit."""
    digits = "".join(c for c in said if c.isdigit())
    if kind == "phone":
        return 10 <= len(digits) <= 15 and not _DATE.match(said)
    return kind != "card" or len(digits) in (15, 16) or luhn(digits[:-1]) == int(digits[-1])


def find(text: str) -> list[tuple[str, int, int]]:
    """Kinds and places of entities, in order."""
    found = []
    if "@" in text or _DIGIT.search(text):
        for m in MARKS.finditer(text):
            if _counts(m.lastgroup, m[0]):
                found.append((m.lastgroup, m.start(), m.end()))
    if not _STARTS.isdisjoint(_CAPITAL.findall(text)) or any(t in text for t in _LOWER_TITLES):
        names = [("name", m.start(), m.end()) for m in NAME.finditer(text)]
        found += [n for n in names if not any(n[1] < end and start < n[2] for _, start, end in found)]
        found.sort(key=lambda x: x[1])
    return found


def anonymise(text: str | None, key: str) -> tuple[str | None, list[dict]]:
    """The text with surrogates, and where they stand in it."""
    if not text:
        return text, []
    parts, entities, at, length = [], [], 0, 0
    for kind, start, end in find(text):
        new = surrogate(kind, text[start:end], key)
        parts += (text[at:start], new)
        length += start - at
        entity = hashlib.sha256(f"{key}|{kind}|{identity(kind, text[start:end])}".encode()).hexdigest()[:32]
        entities.append({"kind": kind, "start": length, "end": length + len(new), "entity": entity, "surrogate": identity(kind, new)})
        length += len(new)
        at = end
    return "".join([*parts, text[at:]]), entities


def replace_entities(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Replace entities in every whole text; adds ``entities`` (places in the new text) and ``n_entities``."""
    kept = docs.drop("entities", "n_entities")
    place = kept.columns.index(text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("entity", pa.string()), ("surrogate", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [anonymise(x.as_py(), key) for x in batch.column(place)]
            columns = list(batch.columns)
            columns[place] = pa.array([t for t, _ in done], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array([e for _, e in done], kind)], names=[*batch.schema.names, "entities"])

    schema = T.StructType([*kept.schema.fields, T.StructField("entities", ENTITY)])
    return kept.mapInArrow(run, schema).withColumn("n_entities", F.size("entities"))


def collisions(replaced: DataFrame) -> DataFrame:
    """``kind, surrogate`` of surrogates that stand for more than one entity anywhere: none, if all is well."""
    flat = replaced.select(F.explode("entities").alias("e")).select("e.kind", "e.surrogate", "e.entity")
    return flat.groupBy("kind", "surrogate").agg(F.min("entity").alias("a"), F.max("entity").alias("b")).filter("a <> b").select("kind", "surrogate")
