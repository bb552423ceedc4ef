"""Personal data replaced by keyed surrogates of the same type and format.

Entities are e-mail and IP addresses, phone, card, account and social security numbers, IBANs,
secrets, and names of persons: behind a title or with a known given name, and wherever such a name
comes again in the same text. An entity has a canonical form, so that its mentions in other formats are the same entity; its surrogate comes from an HMAC
of type and canonical form and is written in the format of each mention: separators, case,
script, country code, card checksum and the gender of given names stay.

Surrogates are checked over the whole corpus: two entities with one surrogate, or a surrogate that
is somebody's real value, make all but one of them take their next surrogate, until none collide.
Surrogates get longer after ``SAME_LENGTH`` attempts, so a shape that is nearly all in use ends, too.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.base import tasks_for, text_digest, unused, written
from almanac.session import ship_package

ROWS_AT_ONCE = 512
SAME_LENGTH = 8  # attempts; each later one makes the surrogate longer by one

# --- fixed values -----------------------------------------------------------
TITLES = {
    "m": ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "г-н"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta",
          "госпожа", "г-жа"],
    "n": ["Dr", "Prof", "Professor", "Doctor", "доктор"],
}
GIVEN_NAMES = {
    "m": ["James", "John", "Robert", "Michael", "William", "David", "Richard", "Thomas", "Peter",
          "Paul", "Hans", "Klaus", "Jürgen", "Pierre", "Jean", "Luis", "Carlos", "Miguel", "José",
          "Иван", "Сергей", "Николай"],
    "f": ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica",
          "Sarah", "Karen", "Anna", "Petra", "Ursula", "Marie", "Camille", "Carmen", "Lucía",
          "María", "Ольга", "Елена", "Наталья"],
}
RESERVED_DOMAINS = ("example.com", "example.net", "example.org")
LETTERS = "abcdefghijklmnopqrstuvwxyz"
PHONE_DIGITS = 10
MARKS = "!#$%&*+-.:?@^_~"
SYLLABLES = {
    "latin": ("bdfgklmnprstv", "aeiou", "nrsl"),
    "cyrillic": ("бвгдклмнпрст", "аеиоу", "нрсл"),
    "greek": ("βγδκλμνπρστ", "αεηιο", "νσς"),
}
ENDINGS = {"m": {"latin": "o", "cyrillic": "", "greek": "ος"},
           "f": {"latin": "a", "cyrillic": "а", "greek": "α"}}
# ----------------------------------------------------------------------------



def _plain(name: str) -> str:
    """A Latin name without accents; any other as it is."""
    letters = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return letters if letters.isascii() else name


_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_VALUE = r"[\"']?(?P<value>[^\s\"',;]{6,})"
_CAPITAL = r"[^\W\d_a-zà-öø-ÿа-яά-ώ][^\W\d_]+(?:(?!['’]s(?!\w))[-'’][^\W\d_]+)*"
STRUCTURED = [
    ("secret", re.compile(r"(?<!\w)(?i:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}"
                          + _VALUE)),
    ("secret", re.compile(r"(?<!\w)(?P<value>AKIA[0-9A-Z]{16}|gh[pousr]_\w{20,}|sk-[\w-]{20,})"
                          r"(?!\w)")),
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}+@[A-Za-z0-9-]{1,63}+"
                         r"(?:\.[A-Za-z0-9-]{1,63}+){1,8}")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("ip6", re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:)[0-9A-Fa-f:]{2,39}"
                       r"(?:(?<=::)|(?<!:))(?!\w|:[0-9A-Fa-f:]|\.\d)")),
    ("ip", re.compile(rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d)")),
    ("phone", re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}"
                         r"(?:[ .-]\d{2,4}){1,4}(?!\w)|(?<![\w+])\+\d{8,15}(?!\w)|"
                         r"(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|"
                         r"(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("card", re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])")),
]
_HEX = re.compile(r"[0-9a-f]{8,}|[0-9A-F]{8,}")
_TITLE_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_TITLE_WORDS = {t.casefold() for t in _TITLE_GENDER}
_GIVEN_GENDER = {form.casefold(): g for g, names in GIVEN_NAMES.items() for n in names
                 for form in (n, _plain(n))}
_ANY_TITLE = "|".join(sorted(map(re.escape, _TITLE_GENDER), key=len, reverse=True))
_TITLED = re.compile(rf"(?<!\w)(?P<titles>(?:(?:{_ANY_TITLE})\.?[  ]){{1,3}})"
                     rf"(?P<names>{_CAPITAL}(?: {_CAPITAL}){{0,2}})")
_KNOWN = re.compile(r"(?<!\w)(?P<names>(?:" + "|".join(sorted(
    {re.escape(form) for names in GIVEN_NAMES.values() for n in names for form in (n, _plain(n))})
    ) + rf")(?: {_CAPITAL}){{1,2}})")
_WORD = re.compile(rf"(?<!\w){_CAPITAL}(?!\w)")


def _luhn(digits: str) -> int:
    """The check digit behind ``digits``."""
    total = 0
    for at, digit in enumerate(reversed(digits)):
        n = int(digit) * (2 if at % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "").split(" ")[0].lower()
    return name if name in SYLLABLES else "latin"


def _names(match: re.Match, gender: str) -> Iterator[tuple[int, int, str, str, str]]:
    """``start, end, word, role, gender`` of the given names and the family name of a match. A
    word that stands alone behind a title may be either."""
    at = match.start("names")
    words = match["names"].split(" ")
    known = [_GIVEN_GENDER.get(w.casefold()) for w in words]
    gender = next((g for g in known if g), gender)
    for place, word in enumerate(words):
        if len(words) > 1:
            role = "family" if place == len(words) - 1 else "given"
        else:
            role = "given" if known[place] else "either"
        yield at, at + len(word), word, role, gender
        at += len(word) + 1


def _persons(text: str, free: Callable[[int, int], bool]) -> list[tuple[int, int, str, str]]:
    """The names, and all later and earlier mentions of the same words in the text.

    In a text a given name has one gender: its own, or else the first that a title or another
    given name tells.
    """
    found = []
    for pattern in (_TITLED, _KNOWN):
        for match in pattern.finditer(text):
            gender = "n"
            if pattern is _TITLED:
                genders = [_TITLE_GENDER[t] for t in re.findall(_ANY_TITLE, match["titles"])]
                gender = next((g for g in genders if g != "n"), "n")
            if free(match.start("names"), match.end("names")):
                found.extend(_names(match, gender))
    if not found:
        return []
    given: dict[str, str] = {}
    families = set()
    for _, _, word, role, gender in sorted(found):
        key = word.casefold()
        if role == "given":
            if given.get(key, "n") == "n":
                given[key] = _GIVEN_GENDER.get(key, gender)
        elif role == "family":
            families.add(key)
    families |= {key for key in (f[2].casefold() for f in found if f[3] == "either")
                 if key not in given}

    def entity(start: int, word: str, role: str) -> tuple[int, int, str, str]:
        key = word.casefold()
        is_family = role == "family" or role == "either" and key in families
        kind = "family" if is_family else f"given.{given[key]}"
        return start, start + len(word), f"{kind}.{_script(word)}", key

    out = [entity(start, word, role) for start, _, word, role, _ in found]
    named = (families | given.keys()) - _TITLE_WORDS
    for match in _WORD.finditer(text):
        words = [match]
        if match[0].casefold() not in named:  # one name of a compound
            words = re.finditer(r"[^\W\d_]+", match[0]) if re.search(r"[-'’]", match[0]) else []
        for word in words:
            start = match.start() + (word.start() if word is not match else 0)
            if (word[0].casefold() in named and word[0][0].isupper()
                    and free(start, start + len(word[0]))):
                out.append(entity(start, word[0], "either"))
    return out


def _replaced_part(kind: str, canonical: str) -> str:
    """What a surrogate changes of a secret or a mailbox; the rest of it is fixed."""
    if kind == "email":
        local, domain = canonical.rsplit("@", 1)
        return local if domain.endswith(RESERVED_DOMAINS) else canonical
    return canonical[len(_prefix(canonical)):]


def _prefix(secret: str) -> str:
    if re.match(r"gh[pousr]_", secret):
        return secret[:4]
    return next((p for p in ("AKIA", "sk-") if secret.startswith(p)), "")


def _ip6(mention: str) -> str | None:
    """The shortest form of an address of a host; nothing for other text, such as ``a::b``."""
    try:
        address = ipaddress.IPv6Address(mention)
    except ValueError:
        return None
    groups = [g for g in mention.split(":") if g]
    if address.is_loopback or len(groups) < 3 and not any(map(str.isdigit, mention)):
        return None
    return address.compressed if groups else None


def _masked(kind: str, canonical: str) -> bool:
    """Whether nothing is left to hide: no character, or one mark again and again."""
    part = set(_replaced_part(kind, canonical))
    return len(part) < 2 and not any(c.isalpha() or c.isdigit() for c in part)


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, canonical`` of the entities, from left to right, without overlaps."""
    found: list[tuple[int, int, str, str]] = []

    taken = bytearray()

    def free(start: int, end: int) -> bool:
        """Mark the place as taken, if nothing has it yet."""
        if not taken:
            taken.extend(bytes(len(text)))
        if taken.find(1, start, end) >= 0:
            return False
        taken[start:end] = b"\1" * (end - start)
        return True

    if "@" in text or "=" in text or ":" in text or re.search(r"\d", text):
        for kind, pattern in STRUCTURED:
            if kind == "email" and "@" not in text:
                continue
            if kind == "ip6" and "::" not in text and text.count(":") < 7:
                continue
            for match in pattern.finditer(text):
                start, end = match.span("value" if kind == "secret" else 0)
                mention = text[start:end]
                named = kind
                if kind == "card":
                    digits = _digits(mention)
                    named = "card" if _luhn(digits[:-1]) == int(digits[-1]) else "account"
                    canonical = digits
                elif kind == "phone":
                    canonical = _digits(mention)[-PHONE_DIGITS:]
                elif kind == "ssn":
                    canonical = _digits(mention)
                elif kind == "iban":
                    canonical = mention.replace(" ", "")
                elif kind == "email":
                    canonical = mention.lower()
                elif kind == "ip6":
                    canonical = _ip6(mention)
                else:
                    canonical = mention
                if not canonical or kind in ("secret", "email") and _masked(kind, canonical):
                    continue
                if free(start, end):
                    found.append((start, end, named, canonical))
    found.extend(_persons(text, free))
    return sorted(found)


class _Draw:
    """Numbers from the HMAC of type, canonical form and attempt."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        message = f"{kind}\0{canonical}\0{attempt}\0".encode()
        self.next_block = lambda n: hmac.new(key, message + str(n).encode(), hashlib.sha256)
        self.value, self.blocks = 0, 0
        self.room = 1

    def below(self, n: int) -> int:
        if self.room < n << 64:
            self.value = int.from_bytes(self.next_block(self.blocks).digest(), "big")
            self.room = 1 << 256
            self.blocks += 1
        self.value, out = divmod(self.value, n)
        self.room //= n
        return out

    def of(self, choices: str) -> str:
        return choices[self.below(len(choices))]


def _like(text: str, draw: _Draw, more: int = 0, marks: str = MARKS) -> str:
    """Other characters of the same classes, and ``more`` of the last one's; separators stay,
    hexadecimal text stays it. Text of separators only gets others of ``marks``."""
    last = next((c for c in reversed(text) if c.isalpha() or c.isdigit()), None)
    if last is None:
        return "".join(draw.of(marks) for _ in range(len(text) + more))
    text += ("0" if last.isdigit() else "A" if last.isupper() else "a") * more
    letters = "abcdef" if _HEX.fullmatch(text) else LETTERS

    def other(char: str) -> str:
        if char.isdigit():
            return draw.of("0123456789")
        if char.isalpha():
            return draw.of(letters.upper() if char.isupper() else letters)
        return char

    return "".join(map(other, text))


def _number(digits: str, draw: _Draw) -> str:
    return draw.of("23456789") + "".join(draw.of("0123456789") for _ in digits[1:])


def _name(kind: str, draw: _Draw, more: int) -> str:
    script, gender = kind.split(".")[-1], kind.split(".")[1]
    onsets, vowels, codas = SYLLABLES[script]
    syllables = [draw.of(onsets) + draw.of(vowels) for _ in range(4 + more)]
    if kind.startswith("given"):
        end = ENDINGS.get(gender, {}).get(script, "")
        return "".join(syllables[:-1]) + draw.of(onsets) + end
    return "".join(syllables) + draw.of(codas)


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The canonical form of the entity's surrogate."""
    draw = _Draw(key, kind, canonical, attempt)
    more = max(0, attempt - SAME_LENGTH + 1)
    if kind.startswith(("given", "family")):
        return _name(kind, draw, more)
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "ip6":  # of the addresses for documentation; the run of zeros can be shortened
        groups = [0x2001, 0xDB8, *[1 + draw.below(0xFFFF) for _ in range(min(more, 2))],
                  *[0] * (2 - min(more, 2)), *[1 + draw.below(0xFFFF) for _ in range(4)]]
        return ipaddress.IPv6Address(":".join(f"{g:x}" for g in groups)).compressed
    if kind == "card":
        body = canonical[0] + "".join(draw.of("0123456789") for _ in range(
            len(canonical) - 2 + more))
        return body + str(_luhn(body))
    if kind in ("account", "phone", "ssn"):
        return _number(canonical + "0" * more, draw)
    if kind == "iban":
        body = _like(canonical[4:], draw, more)
        check = int("".join(str(int(c, 36)) for c in body + canonical[:2] + "00")) % 97
        return f"{canonical[:2]}{98 - check:02d}{body}"
    if kind == "email":
        local, domain = canonical.rsplit("@", 1)
        if not domain.endswith(RESERVED_DOMAINS):
            host, _, top = domain.rpartition(".")
            domain = _like(host, draw, marks=LETTERS) + "." + top
        return _like(local, draw, more, LETTERS) + "@" + domain
    prefix = _prefix(canonical)
    return prefix + _like(canonical[len(prefix):], draw, more)


def render(kind: str, mention: str, canonical: str) -> str:
    """The surrogate in the format of the mention."""
    if kind in ("card", "account", "ssn", "phone", "iban"):
        rest = iter(canonical)
        # A country code stays.
        skip = sum(c.isalnum() for c in mention) - PHONE_DIGITS if kind == "phone" else 0
        out = []
        for char in mention:
            if not char.isalnum():
                out.append(char)
            elif skip > 0:
                skip -= 1
                out.append(char)
            else:
                out.append(next(rest))
        return "".join([*out, *rest])
    if kind.startswith(("given", "family")):
        return canonical.upper() if mention.isupper() else canonical.capitalize()
    if kind == "ip6" and "::" not in mention:
        whole = ipaddress.IPv6Address(canonical).exploded.split(":")
        if min(map(len, mention.split(":"))) < 4:
            whole = [f"{int(group, 16):x}" for group in whole]
        canonical = ":".join(whole)
    if kind in ("email", "ip6") and mention.isupper():
        return canonical.upper()
    return canonical


def replace(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, int]:
    """The text with surrogates, and how many mentions were replaced."""
    out, at, found = [], 0, detect(text)
    for start, end, kind, canonical in found:
        new = surrogate(key, kind, canonical, attempts.get((kind, canonical), 0))
        out += [text[at:start], render(kind, text[start:end], new)]
        at = end
    return "".join([*out, text[at:]]), len(found)


def mentions(docs: DataFrame) -> DataFrame:
    """``digest, kind, canonical``: the distinct entities of each text."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(digest, *entity)
                     for digest, text in zip(batch.column("digest").to_pylist(),
                                             batch.column("text").to_pylist())
                     for entity in sorted({e[2:] for e in detect(text or "")})]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], kind) for i, kind in
                 enumerate((pa.binary(), pa.string(), pa.string()))],
                ["digest", "kind", "canonical"])

    return docs.select(text_digest().alias("digest"), "text").mapInArrow(
        run, "digest binary, kind string, canonical string")


def _with_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "canonical", "attempt")))
            yield batch.append_column("surrogate", pa.array(
                [surrogate(key, *row) for row in rows], pa.string()))

    return entities.mapInArrow(
        run, "kind string, canonical string, attempt int, surrogate string")


def surrogate_table(found: DataFrame, key: bytes) -> DataFrame:
    """``kind, canonical, attempt, surrogate`` of the distinct entities, without collisions."""
    entities = found.select("kind", "canonical").distinct().withColumn("attempt", F.lit(0))
    while True:
        table = written(_with_surrogates(entities, key), "pii-surrogates")
        same = Window.partitionBy("kind", "surrogate").orderBy("attempt", "canonical")
        real = table.select(F.col("kind").alias("k"), F.col("canonical").alias("c")).distinct()
        judged = (
            table.withColumn("place", F.row_number().over(same))
            .join(real, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("c")), "left")
            .withColumn("collides", (F.col("place") > 1) | F.col("c").isNotNull())
        )
        if judged.where("collides").isEmpty():
            return table
        entities = judged.select("kind", "canonical",
                                 (F.col("attempt") + F.col("collides").cast("int")).alias("attempt"))


def _with_attempts(docs: DataFrame, found: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """``docs`` with an array of the entities of each text that didn't get their first surrogate.

    Without any the texts aren't joined. Otherwise the few rows are a written table, whose size
    lets Spark choose between a broadcast and a shuffle.
    """
    late = table.where("attempt > 0").select("kind", "canonical", "attempt")
    if late.isEmpty():
        return docs.withColumn(
            name, F.lit(None).cast("array<struct<kind:string,canonical:string,attempt:int>>"))
    digest = unused(docs, "attempts_digest")
    by_text = written(
        found.join(late, ["kind", "canonical"]).groupBy(F.col("digest").alias(digest)).agg(
            F.collect_set(F.struct("kind", "canonical", "attempt")).alias(name)), "pii-late")
    return docs.withColumn(digest, text_digest()).join(by_text, digest, "left").drop(digest)


def replace_pii(docs: DataFrame, key: bytes, length: str | None = None,
                count: str | None = None) -> DataFrame:
    """The rows of ``docs`` with surrogates in ``text``, other columns as they are.

    ``length`` names a column that gets the new text's length where it isn't null, ``count`` a new
    column for the number of replaced mentions. Null texts stay null. Equal entities get equal
    surrogates in all documents, so equal texts stay equal; no documents give no rows.
    """
    ship_package(docs.sparkSession)
    late = unused(docs, "late")
    with tasks_for(docs):
        found = written(mentions(docs).distinct(), "pii-mentions")
        rows = _with_attempts(docs, found, surrogate_table(found, key), late)
    edit: Callable = _replacer(docs.columns, late, key, length, count)
    schema = docs.schema
    if count:
        schema = docs.select("*", F.lit(0).alias(count)).schema
    return rows.mapInArrow(edit, schema)


def _replacer(columns: list[str], late: str, key: bytes, length: str | None,
              count: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                attempts = [{(e["kind"], e["canonical"]): e["attempt"] for e in entities or []}
                            for entities in part.column(late).to_pylist()]
                texts = part.column("text").to_pylist()
                new = [(t, 0) if t is None else replace(t, key, a)
                       for t, a in zip(texts, attempts)]
                arrays = {c: part.column(c) for c in columns}
                arrays["text"] = pa.array([t for t, _ in new], part.column("text").type)
                if length:
                    old = part.column(length)
                    arrays[length] = pa.array(
                        [None if n is None or t is None else len(t)
                         for n, (t, _) in zip(old.to_pylist(), new)], old.type)
                if count:
                    arrays[count] = pa.array([n for _, n in new], pa.int32())
                yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    return run
