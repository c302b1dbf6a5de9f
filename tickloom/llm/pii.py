"""Personal data: detection, and replacement by keyed surrogates.

A surrogate is drawn from a keyed hash of (kind, entity, attempt) and has the entity's kind, script,
gender and format: digits of a phone or card number are poured into the layout in which it was written,
numbers with a check sum keep it, secrets keep the prefix that tells whose they are, name parts keep gender,
script and case. An entity has one surrogate wherever it occurs, so references stay together across documents
and layouts. Given and family names are entities of their own; the gender of a given name is the one that
most titles before it tell, over the corpus, and a family name's is in its form. A name that is found once in a
text is replaced wherever it stands there.

Distinctness is checked over the whole corpus, in Spark: a surrogate may equal neither an entity that
occurs nor another entity's surrogate. Losers of a collision draw again (attempt + 1) until none is left; every
WIDER draws a format gets more room, so a small format that is used up ends this too. What is not a pure
function of the entity (later draws, genders that titles tell) is sent along or joined by text.

Texts are searched twice, before and after surrogates are settled: that costs less than a table of them.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.common import free_name, stage, unstage
from tickloom.llm.tokens import in_slices

#: The session's setting that holds the surrogates' key.
KEY = "spark.tickloom.surrogates.key"
#: Draws after which a format gets more room, by one step each time: it may be used up.
WIDER = 8
#: Redrawn entities up to which they are sent along with every task (about 10 MB); beyond it they are joined.
MOST_SENT = 100_000

LOCAL_MARKS = "_.+%-"
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9](?:[\w-]*\w)?(?:\.[A-Za-z0-9](?:[\w-]*\w)?)*\.[A-Za-z]{2,24}")
#: A run of digits and the marks that occur in numbers.
NUMBER = re.compile(r"\d(?:[\d.]|[ ()/-]{1,2}(?=[\d(]))*")
IPV4 = re.compile(r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}")
#: A payment card's number starts with 2 to 6 and passes the check sum; other long numbers are none.
CARD = re.compile(r"\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}|3[47]\d{2}([ -]?)\d{6}\2\d{5}")
SSN = re.compile(r"\d{3}-\d{2}-\d{4}")
PHONE = re.compile(r"\+ ?\d{1,3}(?:[ ./-]?\(?\d{2,5}\)?)(?:[ ./-]?\d{2,5}){1,4}|\(\d{2,5}\)[ ./-]?\d{2,5}(?:[ ./-]?\d{2,5}){1,3}|\d{3}[ .-]\d{3}[ .-]\d{4}")
#: The fixed length of numbers of country code 1; no number has more than MOST_DIGITS digits (E.164).
NANP = re.compile(r"(?:\+ ?1[ ./-]?)?\(?\d{3}\)?[ ./-]?\d{3}[ ./-]?\d{4}(?![./-]?\d)")
MOST_DIGITS = 15
NUMBERS = (("ip", IPV4), ("card", CARD), ("ssn", SSN), ("phone", PHONE))
GROUP, MARKS = re.compile(r"[+(]? ?\d*"), re.compile(r"[ ./)-]*")
IBAN_START = re.compile(r"[A-Z]{2}\d{2}")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
#: An assigned value, quoted or not; what stands before it decides whether it is a secret. A quoted one with spaces starts with a long word.
ASSIGNED = re.compile(
    r"[=:]\s{0,4}(?:([\"'`])((?:\\.|(?!\1)[^\\\s]){8,}|(?=[A-Za-z0-9_+/.\-]{8})(?:\\.|(?!\1)[^\\\n]){8,})\1|[\"'`]?([A-Za-z0-9_+/.\-][A-Za-z0-9_+/.\-!@#$%^*~]{7,}={0,2}))"
)
SECRET_NAME = re.compile(r"(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key|client[_ -]?secret|credential)s?[\"'`]?\s{0,4}$", re.IGNORECASE)
SECRET_PREFIX = re.compile(r"AKIA|gh[pousr]_|sk-(?:proj-|ant-)?|xox[abprs]-|eyJ")
KNOWN_SECRET = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,})")
#: Titles of address with the gender they tell.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Madam": "f", "Herr": "m", "Herrn": "m", "Frau": "f", "M": "m",
    "Monsieur": "m", "Mme": "f", "Madame": "f", "Mlle": "f", "Sr": "m", "Sra": "f", "Señor": "m", "Señora": "f", "Dr": "u", "Prof": "u",
    "г-н": "m", "г-жа": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
#: Common given names, for the gender of a name whose title does not tell it.
GIVEN = {
    "f": "anna maria mary emma olivia sophie sophia julia laura sarah jane linda susan karen lisa elena marie claire camille lucia carmen sofia ana isabel petra monika sabine anke olga natalia анна мария елена ольга наталья татьяна μαρία ελένη",
    "m": "john james robert michael william david thomas peter paul mark george daniel martin hans karl stefan jürgen pierre jean louis luc antoine carlos juan josé luis miguel ivan dmitri иван дмитрий сергей алексей михаил γιώργος νίκος",
}
GENDER_OF = {name: gender for gender, names in GIVEN.items() for name in names.split()}
_PART = r"[A-ZÀ-ÖØ-ÞА-ЯЁΑ-Ω][a-zà-öø-ÿа-яёά-ώA-ZÀ-ÖØ-ÞА-ЯЁΑ-Ω'’-]+"
#: Words after which a name stands without a title.
CUE = re.compile(rf"(?<!\w)(?:[Mm]y name is|[Nn]ame:|[Nn]ame is|[Cc]ontact:|[Aa]uthor:|[Pp]atient:|[Cc]ustomer:|[Ss]igned,|[Ss]incerely,|[Rr]egards,)\s+({_PART}) ({_PART})(?!\w)")
CUE_ENDS = ("ame is", "ame:", "ontact:", "uthor:", "atient:", "ustomer:", "igned,", "incerely,", "egards,")
_TITLE = "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
NAME = re.compile(rf"(?<!\w)({_TITLE})(\.? )({_PART})(?: ({_PART}))?(?!\w)")
#: Where a name may start after a title, and the title that ends there.
BEFORE_NAME = re.compile(rf"[{''.join(sorted({t[-1] for t in TITLES}))}]\.? (?={_PART[: _PART.index(']') + 1]})")
TITLE_END = re.compile(rf"(?<!\w)(?:{_TITLE})$")
LONGEST_TITLE = max(map(len, TITLES))
MENTION = re.compile(rf"(?<!\w){_PART}(?!\w)")
POSSESSIVE = re.compile(r"['’][sS]?$")

LATIN, CYRILLIC, GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"
#: Syllables and gendered endings from which names of each script are made.
NAMES = {
    "latin": (["ma", "le", "ro", "ka", "ni", "do", "va", "se", "li", "jo", "ber", "tan", "mir", "cor", "hel"], {"m": ["n", "s", "rd", "lf", "no"], "f": ["na", "la", "ra", "tte", "lia"], "u": ["n", "l", "ris", "ne", "m"]}, ["son", "mann", "ell", "er", "ard", "ini", "ez", "eau"]),
    "cyrillic": (["ма", "ле", "ро", "ка", "ни", "до", "ва", "се", "ли", "бо", "тан", "мир"], {"m": ["н", "слав", "р"], "f": ["на", "ра", "лия"], "u": ["н", "м", "ль"]}, ["ов", "ин", "ев"]),
    "greek": (["μα", "λε", "ρο", "κα", "νι", "δο", "βα", "σε", "λι", "θε", "παν"], {"m": ["νος", "ρης", "λος"], "f": ["να", "ρα", "λία"], "u": ["ν", "λ", "ρι"]}, ["πουλος", "ίδης", "άκης"]),
}


def script_of(text: str) -> str:
    c = text[:1].lower()
    return "cyrillic" if "а" <= c <= "ё" else "greek" if "ά" <= c <= "ώ" else "latin"


def luhn(digits: str) -> int:
    """The check sum's remainder: 0 if the number is valid."""
    return sum((d if i % 2 == 0 else 2 * d - 9 * (d > 4)) for i, d in enumerate(map(int, reversed(digits)))) % 10


def iban_check(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, entity) in order, not overlapping; an earlier kind of the list below wins.

    Entities are written in one form, whatever their layout: digits only, or lower case.
    """
    return [f[:4] for f in found(text)]


def found(text: str | None) -> list[tuple[int, int, str, str, str]]:
    """What detect finds, each with the gender that a title tells of it, or an empty text."""
    if not text:
        return []
    out: list[tuple[int, int, int, str, str, str]] = []
    at = text.find("@")
    while at >= 0:
        domain, start = EMAIL_DOMAIN.match(text, at + 1), at
        if domain:
            while start and (text[start - 1].isalnum() or text[start - 1] in LOCAL_MARKS):
                start -= 1
            start += len(text[start:at]) - len(text[start:at].lstrip("."))
            if start < at:
                out.append((0, start, domain.end(), "email", text[start : domain.end()].lower(), ""))
        at = text.find("@", at + 1)
    if "=" in text or ":" in text:
        for m in ASSIGNED.finditer(text):
            # the longest name of a secret, with quotes and spaces, has 19 characters
            if SECRET_NAME.search(text, max(0, m.start() - 24), m.start()):
                group = 2 if m[2] else 3
                value = m[2] or m[3].rstrip(".!")
                out.append((1, m.start(group), m.start(group) + len(value), "secret", value.lower() if _hex(value) else value, ""))
    if SECRET_PREFIX.search(text):
        out += [(1, m.start(), m.end(), "secret", m[0], "") for m in KNOWN_SECRET.finditer(text)]
    for run in NUMBER.finditer(text):
        at, end = run.span()
        if end - at >= 5:
            before = text[max(0, at - 2) : at]
            at -= 2 if before == "+ " else 1 if before[-1:] in ("+", "(") else 0
            if text[max(0, at - 1) : at] == "+":  # "+(44) .."
                at -= 1
            if end - at >= 7:
                out += _numbers(text, at, end)
    if IBAN_START.search(text):
        for m in IBAN.finditer(text):
            compact = m[0].replace(" ", "")
            if 15 <= len(compact) <= 34 and iban_check(compact) == 1:
                out.append((1, m.start(), m.end(), "iban", compact, ""))
    out += _names(text)
    return _resolved(out)


def _names(text: str) -> list[tuple[int, int, int, str, str, str]]:
    """Names after titles and cues, and every other mention of their parts."""
    out: list[tuple[int, int, int, str, str, str]] = []
    for before in BEFORE_NAME.finditer(text):
        title = TITLE_END.search(text, max(0, before.start() + 1 - LONGEST_TITLE), before.start() + 1)
        m = NAME.match(text, title.start()) if title else None
        if m:
            out += _name(m, 3 if m[4] else None, 4 if m[4] else 3, TITLES[m[1]])
    if any(end in text for end in CUE_ENDS):
        for m in CUE.finditer(text):
            out += _name(m, 1, 2, "u")
    if out:
        known: dict[str, str] = {}
        for _, _, _, kind, entity, _ in sorted(out, key=lambda f: (f[3].startswith("given"), f[1])):
            known.setdefault(entity, kind)
        for m in MENTION.finditer(text):
            word = POSSESSIVE.sub("", m[0])
            if word.lower() in known:
                out.append((4, m.start(), m.start() + len(word), known[word.lower()], word.lower(), ""))
    return out


def _name(m: re.Match, given: int | None, last: int, gender: str) -> Iterator[tuple[int, int, int, str, str, str]]:
    """The parts of a name; each is an entity of its own, so that short forms refer to the same person."""
    for group, part in ((given, "given"), (last, "surname")):
        if group:
            word = POSSESSIVE.sub("", m[group])
            yield 3, m.start(group), m.start(group) + len(word), f"{part}_{script_of(word)}", word.lower(), gender if part == "given" and gender != "u" else ""


def default_gender(kind: str, entity: str) -> str:
    """A name's gender where no title tells it: a family name's by its form, a common given name's by a list."""
    if kind.startswith("given"):
        return GENDER_OF.get(entity, "u")
    return "f" if kind == "surname_cyrillic" and entity.endswith(("а", "я")) else "u"


def _numbers(text: str, at: int, end: int) -> Iterator[tuple[int, int, int, str, str, str]]:
    """The numbers of a known kind in a run of digits and marks, tried at the start of each group."""
    while end - at >= 7:
        for kind, pattern in NUMBERS:
            m = pattern.match(text, at, end)
            if m and kind == "phone":
                m = _phone(text, m, end)
            if m and _alone(text, m) and _valid(kind, m[0]):
                digits = m[0] if kind == "ip" else "+" * (kind == "phone" and m[0][0] == "+") + re.sub(r"\D", "", m[0])
                yield 2, m.start(), m.end(), kind, digits, ""
                at = m.end()
                break
        else:
            at = max(at + 1, GROUP.match(text, at, end).end())
        at = MARKS.match(text, at, end).end()


def _valid(kind: str, number: str) -> bool:
    digits = re.sub(r"\D", "", number)
    if kind == "card":
        return digits[0] in "23456" and luhn(digits) == 0
    if kind == "ssn":
        return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
    return True


def _phone(text: str, m: re.Match, end: int) -> re.Match | None:
    """The phone that starts where m does, without what follows it: the longest that ends with its group of digits."""
    fixed = NANP.match(text, m.start(), end) if m[0].startswith(("(", "+1", "+ 1")) else None
    if fixed and _alone(text, fixed):
        return fixed
    last = m.end()
    for at in range(m.start() + 3, m.end()):
        if text[at - 1] == " " and text[at].isdigit() and any((other := p.match(text, at, end)) and _alone(text, other) and not re.match(r"\.?\d", text[other.end() : other.end() + 2]) for p in (IPV4, CARD)):
            last = at
            break
    for stop in range(last, m.start() + 6, -1):
        short = PHONE.fullmatch(text, m.start(), stop)
        if short and _alone(text, short) and sum(map(str.isdigit, short[0])) <= MOST_DIGITS:
            return short
    return None


def _resolved(found: list[tuple[int, int, int, str, str, str]]) -> list[tuple[int, int, str, str, str]]:
    """By position, without any that overlaps one of a lower rank."""
    kept: list[tuple[int, int, str, str, str]] = []
    for _, start, end, *rest in sorted(found):
        at = bisect_left(kept, (start,))
        if not (at < len(kept) and kept[at][0] < end or at and kept[at - 1][1] > start):
            kept.insert(at, (start, end, *rest))
    return kept


def _alone(text: str, m: re.Match) -> bool:
    before, after = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
    return not (before.isalnum() or before == "_" or after.isalnum() or after == "_")


def _hex(value: str) -> bool:
    return len(value) >= 16 and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) is not None


class Draw:
    """An endless keyed stream of small numbers."""

    def __init__(self, key: bytes, *of: object):
        self.key, self.of, self.block, self.left = key, "\x00".join(map(str, of)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.of + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n

    def digits(self, n: int) -> str:
        return "".join(str(self.below(10)) for _ in range(n))

    def like(self, text: str) -> str:
        """Each letter and digit replaced by one of its script and case; marks stay."""
        out = []
        for c in text:
            if c.isdigit():
                c = str(self.below(10))
            elif c.isalpha():
                letters = {"latin": LATIN, "cyrillic": CYRILLIC, "greek": GREEK}[script_of(c)]
                new = letters[self.below(len(letters))]
                c = new.upper() if c.isupper() else new
            out.append(c)
        return "".join(out)


def surrogate(kind: str, entity: str, attempt: int, key: bytes, gender: str | None = None) -> str:
    """The entity's surrogate in the same written form as the entity; gender None: the default one."""
    draw, wider = Draw(key, kind, entity, attempt), attempt // WIDER
    if kind == "email":
        local, domain = entity.rsplit("@", 1)
        name, top = domain.rsplit(".", 1)
        return f"{draw.like(local + 2 * wider * 'x')}@{draw.like(name)}.{top}"
    if kind == "ip":
        parts = entity.split(".")
        spans = {1: (0, 9), 2: (10, 99), 3: (100, 255)}
        private = 2 if entity.startswith("192.168.") else 1 if parts[0] in ("10", "127") else 0
        # wider: other lengths in the same block, then the largest private block, then any address
        if wider >= 2:
            parts, private = (["10", *parts[1:]], 1) if private and wider == 2 else (parts, 0)
        out = parts[:private]
        for i in range(private, 4):
            low, high = (int(i == 0), 255) if wider else spans[len(parts[i])]
            out.append(str(low + draw.below(min(high, 223 if i == 0 else 255) - low + 1)))
        return ".".join(out)
    if kind == "card":
        body = entity[0] + draw.digits(len(entity) - 2 + wider)
        return body + str(-luhn(body + "0") % 10)
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}" + draw.digits(wider)
    if kind == "phone":
        keep = 2 if entity.startswith("+") else 0  # the country code's first digit
        return entity[:keep] + draw.digits(len(entity) - keep + 2 * wider)
    if kind == "iban":
        body = draw.like(entity[4:]) + draw.digits(wider)
        return f"{entity[:2]}{98 - iban_check(entity[:2] + '00' + body):02d}{body}"
    if kind == "secret":
        known = SECRET_PREFIX.match(entity)
        prefix = known[0] if known else ""
        rest = entity[len(prefix) :]
        return prefix + ("".join("0123456789abcdef"[draw.below(16)] for _ in rest) if _hex(rest) else draw.like(rest)) + draw.digits(2 * wider)
    part, script = kind.split("_")
    gender = gender or default_gender(kind, entity)
    syllables, endings, families = NAMES[script]
    stem = "".join(syllables[draw.below(len(syllables))] for _ in range(2 + attempt // 4 + (part == "surname")))
    if part == "given":
        return stem + endings[gender][draw.below(len(endings[gender]))]
    family = families[draw.below(len(families))]
    return stem + family + ("а" if script == "cyrillic" and gender == "f" else "")


def written(original: str, kind: str, new: str) -> str:
    """The surrogate in the layout and case of the original."""
    if kind in ("card", "ssn", "phone", "iban"):
        symbols = iter(new.replace("+", ""))
        return "".join(next(symbols) if c.isalnum() else c for c in original) + "".join(symbols)
    if original.isupper() and any(c.isalpha() for c in original):
        return new.upper()
    if kind.startswith(("given", "surname")):
        return new[:1].upper() + new[1:]
    if kind == "email":
        return "".join(c.upper() if o.isupper() else c for o, c in zip(original.ljust(len(new)), new))
    return new


def rewrite(text: str | None, known: dict[tuple[str, str], tuple[int, str]], key: bytes) -> tuple[str | None, int]:
    """The text with surrogates, and how many there are. known: (attempt, gender) of entities that do not have
    the first draw and the default gender."""
    spans = detect(text)
    if not spans:
        return text, 0
    out, at = [], 0
    for start, end, kind, entity in spans:
        attempt, gender = known.get((kind, entity), (0, None))
        out += [text[at:start], written(text[start:end], kind, surrogate(kind, entity, attempt, key, gender))]
        at = end
    return "".join(out) + text[at:], len(spans)


def _draw_all(key: bytes):
    @F.pandas_udf("string")
    def draw(kind: pd.Series, entity: pd.Series, attempt: pd.Series, gender: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, int(a), key, g) for k, e, a, g in zip(kind, entity, attempt, gender)], dtype=object)

    return draw


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """Distinct (kind, entity) with gender and more -> with attempt and surrogate; surrogates are distinct and none is an
    entity. Ends for any entities: draws get more room as they go on."""
    draw, settled = _draw_all(key), None
    todo = entities.withColumn("attempt", F.lit(0))
    while True:
        drawn = todo.withColumn("surrogate", draw("kind", "entity", "attempt", "gender"))
        taken = entities.select("kind", F.col("entity").alias("surrogate"))
        if settled is not None:
            taken = taken.union(settled.select("kind", "surrogate"))
        first = F.row_number().over(W.partitionBy("kind", "surrogate").orderBy("entity")) == 1
        tried = stage(
            drawn.withColumn("first", first).join(taken.distinct().withColumn("used", F.lit(True)), ["kind", "surrogate"], "left").withColumn("ok", F.col("first") & F.col("used").isNull()), "surrogates"
        )
        won = tried.where("ok").select(*todo.columns, "surrogate")
        settled = won if settled is None else settled.union(won)
        todo = tried.where("not ok").select(*todo.columns).withColumn("attempt", F.col("attempt") + 1)
        if todo.isEmpty():
            return settled


def session_key(spark: SparkSession) -> bytes:
    """The key in the session's setting KEY. Without one a random key is drawn, which is gone with the session:
    then nobody can repeat the surrogates, not even the caller."""
    if spark.conf.get(KEY, None) is None:
        spark.conf.set(KEY, secrets.token_hex(32))
    return spark.conf.get(KEY).encode()


def replace_pii(docs: DataFrame, key: bytes, text: str = "text", count: str | None = "n_entities") -> DataFrame:
    """docs with entities in text replaced, and their number in column count (None: no such column).

    Null and empty texts stay as they are; rows, order of columns and all other values are kept; repeated
    rows are rewritten alike; texts of any length are searched whole. A column named as count is replaced.
    An empty table stays empty. key is a secret: whoever has it can recompute the surrogate of a guess.
    """
    key = bytes(key)

    def entities_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: dict[tuple, list[int]] = {}
            for h, t in zip(frame["h"], frame["t"]):
                for _, _, kind, entity, told in found(t):
                    votes = rows.setdefault((h, kind, entity), [0, 0])
                    if told:
                        votes[told == "f"] += 1
            yield pd.DataFrame([(*k, default_gender(k[1], k[2]) if "_" in k[1] else "u", *v) for k, v in rows.items()], columns=["h", "kind", "entity", "plain", "m", "f"])

    hashed = F.xxhash64(F.col(text))
    seen = docs.select(hashed.alias("h"), F.col(text).alias("t")).where("t is not null").mapInPandas(entities_of, "h long, kind string, entity string, plain string, m long, f long")
    seen = stage(seen, "entities")
    told = F.when(F.sum("m") > F.sum("f"), "m").when(F.sum("m") < F.sum("f"), "f").otherwise(F.min("plain"))
    entities = stage(seen.groupBy("kind", "entity").agg(told.alias("gender"), F.min("plain").alias("plain")), "entities")
    redrawn = stage(assign(entities, key).where("attempt > 0 or gender <> plain").select("kind", "entity", "attempt", "gender"), "redrawn")
    unstage(entities)
    body, again_, hash_, number = (free_name(docs, f"_{n}") for n in ("text", "again", "hash", "number"))
    rest = [c for c in docs.columns if c not in (text, count)]
    entry = "struct<kind:string,entity:string,attempt:int,gender:string>"
    everywhere: dict[tuple[str, str], tuple[int, str]] = {}
    if redrawn.count() <= MOST_SENT:
        # few entities differ from their first draw: theirs go along with the task
        everywhere = {(r["kind"], r["entity"]): (r["attempt"], r["gender"]) for r in redrawn.collect()}
        source = docs.select(*rest, F.col(text).alias(body), F.lit(None).cast(f"array<{entry}>").alias(again_))
    else:
        # by text, so that null and repeated ids do no harm; documents without such an entity find no partner
        again = seen.join(redrawn, ["kind", "entity"]).groupBy(F.col("h").alias(hash_)).agg(F.collect_set(F.struct("kind", "entity", "attempt", "gender")).alias(again_))
        source = docs.withColumn(hash_, hashed).join(again, hash_, "left").select(*rest, F.col(text).alias(body), again_)
    out_schema = docs.select(*rest, F.col(text), F.lit(0).cast("long").alias(number)).schema

    out = _rewritten(source, len(rest), out_schema, key, everywhere)
    ordered = [F.col(c) for c in docs.columns if c != count]
    return out.select(*ordered) if count is None else out.select(*ordered, F.col(number).alias(count))


def _rewritten(source: DataFrame, at: int, schema: StructType, key: bytes, everywhere: dict[tuple[str, str], tuple[int, str]]) -> DataFrame:
    """The rewriting pass on Arrow batches: other columns go through untouched, whatever their types. The text
    is column number at, what is known of its entities the next."""
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 2048):
            known = ({(a["kind"], a["entity"]): (a["attempt"], a["gender"]) for a in again} if again else everywhere for again in batch.column(at + 1).to_pylist())
            done = [rewrite(t, k, key) for t, k in zip(batch.column(at).to_pylist(), known)]
            columns = [*batch.columns[:at], pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, schema)
