"""Surrogates for personal data (operator 3).

Detected entities (mail addresses, phone, card, account and social-security
numbers, IP addresses, secrets, names after a form of address, known given names with a surname) are
replaced by keyed values of the same type and format.

Method: every replacement is a keyed permutation of the strings of one
pattern.  A character is mapped within its class (digit, hex digit, Latin,
Greek or Cyrillic vowel or consonant of either case, Hiragana, Katakana, Hangul,
CJK, the letters, marks and digits of every other script of the basic plane), all positions together by a Feistel network over the classes'
sizes.  Length, case, script, punctuation and sound pattern stay; a
permutation gives distinct strings distinct surrogates and the same string the same
one everywhere (coreference) with no table shared between workers.  Values of
another kind are walked over: the permutation is applied again until the
result is valid like the original (Luhn and IBAN check digits, the IP address's own
special block, known given names of one gender, no name list entry for
other names).  Given names known to the lists are permuted among names of
the same gender and script; vowels that end a name are kept, as they mark gender.

Collision checks per document: no two originals share a surrogate, and no
surrogate equals an original of the document.  First draws come from the corpus-wide
permutations; where one is taken, a known given name gets the first free name of its
list in a keyed order, and any other value, or a name whose list is used up, is
drawn again with the next tweak until it is free.  A pattern that has no free
string left (names of two letters, say) grows by one character at a time.  Values drawn again are
outside the permutation, so in another document the same surrogate may stand
for another original; ``collisions`` lists these for a whole table.

Defined results: null text stays null with no entities; an empty text is
unchanged; repeated rows get the same result; an empty table gives no
rows.  Columns other than the named two are not read by ``surrogates``.
"""

from __future__ import annotations

import ipaddress
import re
import unicodedata
from functools import lru_cache
from hashlib import blake2b
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fundlake.llm.common import fresh_name

DEFAULT_KEY = b"replace-this-key"

# Forms of address by language, with the gender they tell.
ADDRESS = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m",
    "Don": "m", "господин": "m", "Господин": "m", "κύριος": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f",
    "Señora": "f", "Señorita": "f", "Sra": "f", "Srta": "f", "Doña": "f", "госпожа": "f", "Госпожа": "f",
    "κυρία": "f", "Κυρία": "f",
    "Dr": "", "Prof": "", "Professor": "", "Doctor": "",
}
# Common given names by gender and script.
GIVEN = {
    "m": ["Adam", "Albert", "Andrew", "Anton", "Carlos", "Charles", "Daniel", "David", "Diego", "Edward", "Felix",
          "Frank", "Georg", "Hans", "Henry", "Hugo", "Jacques", "James", "Javier", "Jean", "John", "Jorge", "Juan",
          "Karl", "Louis", "Luis", "Lukas", "Marc", "Martin", "Max", "Michael", "Miguel", "Pablo", "Paul", "Pedro",
          "Peter", "Philip", "Pierre", "Robert", "Simon", "Stefan", "Thomas", "Victor", "Walter", "William"],
    "f": ["Alice", "Amelie", "Ana", "Andrea", "Anna", "Barbara", "Carmen", "Caroline", "Charlotte", "Claire",
          "Clara", "Diana", "Elena", "Elisabeth", "Emily", "Emma", "Eva", "Helen", "Ines", "Isabel", "Jane", "Julia",
          "Karin", "Laura", "Lena", "Linda", "Lucia", "Margaret", "Maria", "Marie", "Marta", "Mary", "Monica",
          "Nicole", "Nina", "Olivia", "Paula", "Petra", "Rosa", "Sarah", "Sofia", "Sophie", "Susan", "Teresa", "Ursula"],
    "m-cyrillic": ["Александр", "Алексей", "Андрей", "Борис", "Владимир", "Дмитрий", "Иван", "Михаил", "Николай",
                   "Олег", "Павел", "Сергей"],
    "f-cyrillic": ["Анна", "Вера", "Екатерина", "Елена", "Ирина", "Мария", "Наталья", "Нина", "Ольга", "Светлана",
                   "Татьяна", "Юлия"],
}
GIVEN_GROUP = {n: g for g, names in GIVEN.items() for n in names}

VOWELS = "aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýÿœαειηουωάέίήόύώаеёиоуыэюя"


def _classes() -> dict[str, str]:
    """Character -> all characters of its class, built by rule from the letter blocks."""
    blocks = [(0x61, 0x7B), (0xDF, 0x100), (0x3B1, 0x3CA), (0x430, 0x450)]
    groups = ["0123456789"]
    for lo, hi in blocks:
        lower = [chr(c) for c in range(lo, hi) if chr(c).islower() and len(chr(c).upper()) == 1
                 and chr(c).upper().lower() == chr(c)]
        for part in ([c for c in lower if c in VOWELS], [c for c in lower if c not in VOWELS]):
            groups += ["".join(part), "".join(c.upper() for c in part)]
    for lo, hi in [(0x3042, 0x3094), (0x30A2, 0x30F4), (0x4E00, 0x9FA6), (0xAC00, 0xD7A4)]:
        groups.append("".join(map(chr, range(lo, hi))))
    return {c: g for g in [*groups, *_other_letters("".join(groups))] if len(g) > 1 for c in g}


def _other_letters(known: str) -> list[str]:
    """Groups for the letters, marks and digits of all other scripts of the basic plane: those of one
    script, block of 128 and category, vowels apart from consonants where letters are built on a, e, i, o, u, y."""
    held, groups = set(known), {}
    for code in [*range(0x100, 0x3040), *range(0xA000, 0xABFF), *range(0xFB00, 0xFDFF)]:
        c = chr(code)
        kind = unicodedata.category(c)
        if c in held or kind not in ("Lu", "Ll", "Lo", "Mn", "Mc", "Nd"):
            continue
        if kind in ("Lu", "Ll") and (len(c.upper()) != 1 or len(c.lower()) != 1 or c == c.swapcase()):
            continue
        base = unicodedata.normalize("NFD", c)[0].lower()
        script = unicodedata.name(c, "").split(" ")[0]
        groups.setdefault((script, code >> 7, kind, base in VOWELS), []).append(c)
    return ["".join(g) for g in groups.values()]


CLASSES = _classes()
HEX, UPPER_HEX = ({c: g for c in g} for g in ("0123456789abcdef", "0123456789ABCDEF"))
ALL_HEX, ALL_UPPER_HEX = re.compile(r"[0-9a-f]+\Z"), re.compile(r"[0-9A-F]+\Z")
ROUNDS = 8


def permute(text: str, key: bytes, tweak: str, classes: dict[str, str] = CLASSES) -> str:
    """A keyed permutation of all strings with the text's pattern; characters without
    a class stay as they are and belong to the pattern."""
    at = [i for i, c in enumerate(text) if c in classes]
    if not at:
        return text
    groups = [classes[text[i]] for i in at]
    pattern = "".join(classes[c][0] if c in classes else "=" + c for c in text)
    half = (len(at) + 1) // 2
    sides = []
    for part in (range(half), range(half, len(at))):
        value, size = 0, 1
        for j in part:
            value = value * len(groups[j]) + groups[j].index(text[at[j]])
            size *= len(groups[j])
        sides.append([value, size])
    (a, m), (b, n) = sides
    start = blake2b(f"{tweak}|{pattern}".encode(), key=key[:64])

    def mix(r: int, x: int, size: int) -> int:
        h = start.copy()
        h.update(b"%d:%d" % (r, x))
        width = size.bit_length() // 8 + 9
        out = h.digest()
        while len(out) < width:
            h.update(b"+")
            out += h.digest()
        return int.from_bytes(out[:width], "big") % size

    for r in range(0, ROUNDS, 2):
        a = (a + mix(r, b, m)) % m
        b = (b + mix(r + 1, a, n)) % n
    out = list(text)
    for value, part in ((a, range(half)), (b, range(half, len(at)))):
        for j in reversed(part):
            value, k = divmod(value, len(groups[j]))
            out[at[j]] = groups[j][k]
    return "".join(out)


def walk(text: str, key: bytes, tweak: str, valid, classes: dict[str, str] = CLASSES) -> str:
    """Apply the permutation until ``valid``; the original must be valid, so it ends."""
    out = permute(text, key, tweak, classes)
    while not valid(out):
        out = permute(out, key, tweak, classes)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_digits(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in (rest + country).lower() + "00")
    return f"{98 - int(number) % 97:02d}"


def onto(shape: str, chars: str) -> str:
    """Put the characters one after another in place of the shape's letters and digits."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def ip_kind(text: str) -> str:
    try:
        ip = ipaddress.ip_address(text)
    except ValueError:
        return "none"
    if any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return "none"
    return "private" if ip.is_private else "public" if ip.is_global else "other"


def email(value: str, key: bytes, tweak: str) -> str:
    local, _, domain = value.rpartition("@")
    labels = domain.split(".")
    fixed = 2 if labels[-2:-1] == ["example"] else 1  # reserved names stay reserved
    host = ".".join(labels[:-fixed])
    return permute(local, key, "mail" + tweak) + "@" + ".".join(filter(None, [permute(host, key, "host"), *labels[-fixed:]]))


def digits_of(value: str, key: bytes, tweak: str, keep: int = 0) -> str:
    """Permute the digits; grouping does not matter, so one number written in two ways stays one."""
    d = "".join(c for c in value if c.isdigit())
    return onto(value, d[:keep] + permute(d[keep:], key, tweak))


def phone(value: str, key: bytes, tweak: str) -> str:
    keep = len(re.match(r"\+(\d{0,3}?)(?=\D|\d{9,}\Z)|", value)[0].lstrip("+"))
    return digits_of(value, key, "phone" + tweak, keep)


def card(value: str, key: bytes, tweak: str) -> str:
    d = "".join(c for c in value if c.isdigit())
    right = luhn(d)
    return onto(value, walk(d, key, "card" + tweak, lambda x: luhn(x) == right))


def iban(value: str, key: bytes, tweak: str) -> str:
    raw = "".join(c for c in value if c.isalnum())
    country, check, rest = raw[:2], raw[2:4], raw[4:]
    new = permute(rest, key, "iban" + country + tweak)
    if iban_digits(country, rest) == check:
        return onto(value, country + iban_digits(country, new) + new)
    wrong = lambda x: iban_digits(country, x[2:]) != x[:2]
    return onto(value, country + walk(check + rest, key, "iban?" + country + tweak, wrong))


# Address blocks of special use; an address stays in its own block.
BLOCKS = [ipaddress.IPv4Network(b) for b in (
    "0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24",
    "192.88.99.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4")]
BITS = {c: "01" for c in "01"}


def block_of(number: int) -> int:
    """Place of the special block that holds the address, -1 if it is in none."""
    return next((i for i, b in enumerate(BLOCKS) if number >> (32 - b.prefixlen) == int(b.network_address) >> (32 - b.prefixlen)), -1)


def ip(value: str, key: bytes, tweak: str) -> str:
    """An address of the same special block, or outside all of them."""
    bits = f"{int(ipaddress.IPv4Address(value)):032b}"
    block = block_of(int(bits, 2))
    kept = BLOCKS[block].prefixlen if block >= 0 else 0
    new = walk(bits[kept:], key, "ip" + tweak, lambda x: block_of(int(bits[:kept] + x, 2)) == block, BITS)
    return str(ipaddress.IPv4Address(int(bits[:kept] + new, 2)))


def hex_kind(value: str) -> int:
    return 1 if ALL_HEX.match(value) else 2 if ALL_UPPER_HEX.match(value) else 0


def secret(value: str, key: bytes, tweak: str) -> str:
    classes = HEX if ALL_HEX.match(value) else UPPER_HEX if ALL_UPPER_HEX.match(value) else CLASSES
    return walk(value, key, "secret" + tweak, lambda x: hex_kind(x) == hex_kind(value), classes)


def name(value: str, key: bytes, tweak: str) -> str:
    group = GIVEN_GROUP.get(value)
    if group:
        names = GIVEN[group]
        ranked = sorted(names, key=lambda n: blake2b(f"{group}{tweak}|{n}".encode(), key=key[:64]).digest())
        return ranked[(ranked.index(value) + 1) % len(names)]  # a keyed cycle: never the same name
    ends = len(value) - (value[-1:].lower() in VOWELS and len(value) > 2)
    kept = value[ends:]
    return walk(value[:ends], key, "name" + kept + tweak, lambda x: x + kept not in GIVEN_GROUP) + kept


MAKERS = {"email": email, "phone": phone, "ssn": lambda v, k, t: digits_of(v, k, "ssn" + t), "card": card, "iban": iban,
          "ip": ip, "secret": secret, "name": name}

NUMBERS = re.compile(
    r"(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<card>(?<![\w+.-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<phone>(?<!\w)(?:\+\d{1,3}[ .-]?)?\(\d{2,5}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\w)"
    r"|(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-]))"
    r"|(?P<secret>\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,}\b|\bsk-[A-Za-z0-9_-]{20,}"
    r"|(?<![0-9A-Za-z])(?=[0-9a-fA-F]*\d)(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z]))")
ASSIGNED = re.compile(
    r"(?i:\b(?:api[_-]?key|token|secret|passwd|password|pwd|access[_-]?key))[\"']?\s*[:=]\s*[\"']?"
    r"(?P<secret>[A-Za-z0-9+/_\-]{12,}={0,2})")
EMAILS = re.compile(r"(?<![\w.+%-])(?P<email>[\w.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})")
FORMS = re.compile(r"\b(?:" + "|".join(sorted(ADDRESS, key=len, reverse=True)) + r")\.? (?=[^\W\d_])")
# Combining marks belong to words, but not to \w.
MARKS = "".join(chr(c) for c in range(0x300, 0x1E00) if unicodedata.category(chr(c)) in ("Mn", "Mc"))
LETTERS = rf"\w{MARKS}"
WORD = re.compile(rf"[^\W\d_][{LETTERS}]*(?:['\u2019-][{LETTERS}]+)*")
POSSESSIVE = re.compile(r"['\u2019]s\Z")
#: Not after or before a part of the same word; an ending 's is no part of the name.
STARTS, STOPS = rf"(?<![{LETTERS}'\u2019-])", rf"(?![{LETTERS}]|['\u2019-](?!s(?![{LETTERS}]))[{LETTERS}])"
# Particles that stand inside names.
PARTICLES = {"van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "le", "el", "al", "bin", "ibn", "zu", "ter", "y"}
CASELESS_NAMES = 3
KNOWN_NAMES = re.compile(STARTS + "(?:" + "|".join(sorted(GIVEN_GROUP, key=len, reverse=True)) + f")(?= [^\\W\\d_])")

#: Cheap look for the above: capitalised words with another word behind.
CAPITALISED = re.compile(r"[A-Z\u0410-\u042F]\w+(?= \w)")


def caseless(word: str) -> bool:
    return unicodedata.category(word[0]) == "Lo"


def is_name(word: str) -> bool:
    return len(word) > 1 and (word[0].isupper() or caseless(word))


def name_run(text: str, at: int) -> list[str]:
    """The names that follow each other from ``at`` on, one blank between them, over particles; a script
    without capitals does not show where a name ends, so three of its words are taken at most."""
    names, small = [], 0
    while w := WORD.match(text, at):
        word = w[0]
        if is_name(word) and word not in ADDRESS and small < CASELESS_NAMES:
            names.append(POSSESSIVE.sub("", word))
            small += caseless(word)
        elif word not in PARTICLES:
            break
        if text[w.end():w.end() + 1] != " " or POSSESSIVE.search(word):
            break
        at = w.end() + 1
    return names


def found_in(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, in order, without overlaps; earlier patterns win."""
    spans: list[tuple[int, int, str]] = []
    if "@" in text:
        spans += [(*m.span("email"), "email") for m in EMAILS.finditer(text)]
    if "=" in text or ":" in text:
        spans += [(*m.span("secret"), "secret") for m in ASSIGNED.finditer(text)]
    if HAS_DIGIT.search(text):
        for m in NUMBERS.finditer(text):
            if m.lastgroup != "ip" or ip_kind(m["ip"]) != "none":
                spans.append((*m.span(), m.lastgroup))
    people = set()
    for m in FORMS.finditer(text):
        people.update(name_run(text, m.end()))
    if not GIVEN_GROUP.keys().isdisjoint(CAPITALISED.findall(text)):
        for m in KNOWN_NAMES.finditer(text):  # a known given name with a surname behind it needs no form of address
            run = name_run(text, m.start())
            if len(run) > 1:
                people.update(run)
    if people:
        words = re.compile(STARTS + "(?:" + "|".join(map(re.escape, sorted(people, key=len, reverse=True))) + ")" + STOPS)
        spans += [(*m.span(), "name") for m in words.finditer(text)]
    out, end = [], 0
    for s in sorted(enumerate(spans), key=lambda x: (x[1][0], x[0])):
        if s[1][0] >= end:
            out.append(s[1])
            end = s[1][1]
    return out


HAS_DIGIT = re.compile(r"\d")


@lru_cache(100_000)
def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    return MAKERS[kind](value, key, f"#{attempt}" if attempt else "")


def grown(kind: str, value: str) -> str:
    """A longer value, for patterns without a free string; the other kinds have too many strings
    to run out."""
    if kind == "email":
        return "a" + value
    if kind == "name":
        known = [c for c in value if c in CLASSES]  # a script without classes cannot be kept
        return value[:1] + known[-1] + value[1:] if known else "Bababa"
    return value + "0" if kind == "phone" else value


def drawn_again(kind: str, value: str, key: bytes, taken: set[str]) -> str:
    """A surrogate that is not taken: a free given name of the list, or the next free draw."""
    group = GIVEN_GROUP.get(value) if kind == "name" else None
    if group:
        free = [n for n in GIVEN[group] if n not in taken]
        if free:
            return min(free, key=lambda n: blake2b(f"again{group}|{value}|{n}".encode(), key=key[:64]).digest())
    for attempt in count(1):
        if attempt % 50 == 0:
            value = grown(kind, value)
        new = permute(value, key, f"again#{attempt}") if group else surrogate(kind, value, key, attempt)
        if new not in taken and (not group or new not in GIVEN_GROUP):
            return new


def replaced(text: str, key: bytes) -> tuple[str, list[tuple]]:
    """(new text, [(kind, start, end, surrogate)]), offsets in code points of the original."""
    spans = found_in(text)
    if not spans:
        return text, []
    originals = {text[s:e] for s, e, _ in spans}
    values = dict.fromkeys((kind, text[s:e]) for s, e, kind in spans)
    given: dict[tuple[str, str], str] = {}
    taken = set(originals)
    for kind, value in values:
        new = surrogate(kind, value, key)
        if new not in taken:
            given[kind, value] = new
            taken.add(new)
    for kind, value in values:
        if (kind, value) not in given:
            given[kind, value] = drawn_again(kind, value, key, taken)
            taken.add(given[kind, value])
    out, at, rows = [], 0, []
    for s, e, kind in spans:
        new = given[kind, text[s:e]]
        out += [text[at:s], new]
        rows.append((kind, s, e, new))
        at = e
    return "".join([*out, text[at:]]), rows


RESULT = "struct<text:string,entities:array<struct<kind:string,start:int,end:int,surrogate:string>>>"


def surrogate_column(text_col, key: bytes = DEFAULT_KEY):
    """Column struct<text, entities>; the entities do not hold the originals."""

    @arrow_udf(RESULT)
    def column(texts: pa.Array) -> pa.Array:
        new, rows = [], []
        for t in texts.to_pylist():
            text, found = (t, []) if t is None else replaced(t, key)
            new.append(text)
            rows.append([{"kind": k, "start": s, "end": e, "surrogate": v} for k, s, e, v in found])
        entity = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())])
        return pa.StructArray.from_arrays([pa.array(new, pa.string()), pa.array(rows, pa.list_(entity))],
                                          names=["text", "entities"])

    return column.asNondeterministic()(text_col)


def surrogates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = DEFAULT_KEY) -> DataFrame:
    """(id, text with surrogates, n_entities, entities) per input row."""
    return (df.select(F.col(id_col), surrogate_column(F.col(text_col), key).alias("_r"))
            .select(id_col, F.col("_r.text").alias(text_col), F.size("_r.entities").alias("n_entities"),
                    F.col("_r.entities").alias("entities")))


def with_surrogates(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
                    key: bytes = DEFAULT_KEY) -> DataFrame:
    """df with its text replaced and its length column, if there is one, brought up to date."""
    tmp = fresh_name(df.columns, "_pii")
    out = df.withColumn(tmp, surrogate_column(F.col(text_col), key)).withColumn(text_col, F.col(f"{tmp}.text")).drop(tmp)
    if length_col in out.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(df.schema[length_col].dataType))
    return out


def collisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = DEFAULT_KEY) -> DataFrame:
    """Surrogates that stand for more than one original in the whole table: (kind,
    surrogate, originals).  Entities are counted per value before the shuffle."""
    done = df.select(F.col(text_col).alias("t"), surrogate_column(F.col(text_col), key).alias("r"))
    pairs = done.select("t", F.explode("r.entities").alias("e")).select(
        F.col("e.kind").alias("kind"), F.col("e.surrogate").alias("surrogate"),
        F.expr("substring(t, e.start + 1, e.end - e.start)").alias("original")).distinct()
    return pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("originals")).filter("originals > 1")
