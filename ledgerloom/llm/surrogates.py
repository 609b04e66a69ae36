"""Surrogates for personal data: keyed, type-consistent, distinct, coreferent.

Entities (e-mail, phone, IPv4, card, IBAN, social security number, cloud key,
secret, person name behind a title or beginning with a known given name) are
found by patterns and normalised, so all spellings of one entity share one
surrogate in the whole corpus.  A name's gender is settled for a whole text
from all its mentions, so a person met as "Dr" and as "Mr" keeps one
surrogate; where both genders share a name it is drawn without gender.  The
surrogate is drawn by a keyed hash of (kind, normal form, attempt): digits
become digits, letters letters of the same case and script, separators,
lengths, prefixes and check digits stay as the format wants, names keep gender
and script, and every mention is written in its own format.  A secret without
a letter or digit (also a mask such as ``********``) gets drawn punctuation.

Collision check: over the distinct entities of the corpus, a surrogate must
not be an entity found in the corpus, nor be drawn for two entities; the
smallest keeps it and the others draw again with the next attempt, until none
collides.  Attempts widen the space of every kind (longer secrets, mailboxes
and names, all Han characters, at last more digits than the format has), so
this ends however many distinct entities there are.  Only the entities on a later attempt have to be sent to their
texts: they are joined by the text's digest, broadcast if their measured
size is below ``BROADCAST_BYTES`` and by shuffle beyond it.

The key is the caller's, else that of the session setting ``KEY_SETTING``,
else a random one that lasts as long as the application.

Defined results: null text stays null; texts without entities are unchanged;
all other columns are kept as they are; repeated rows are treated alike; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import secrets
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, prepare, stage

BROADCAST_BYTES = 4 << 20
KEY_SETTING = "spark.ledgerloom.surrogateKey"
_drawn_keys: dict[str, bytes] = {}
#: Titles by gender (fixed values).
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Signor", "господин", "г-н", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Señorita", "Signora",
          "госпожа", "г-жа", "κυρία"],
    "n": ["Dr", "Prof", "Professor"],
}
#: Han titles follow the name.
HAN_TITLES = {"先生": "m", "女士": "f", "小姐": "f"}
#: Given names that begin a person's name without a title (fixed values).
GIVEN = {
    "m": ["Adam", "Ahmed", "Alexander", "Andreas", "Andrew", "Anthony", "Antonio", "Benjamin", "Brian", "Carlos",
          "Charles", "Christopher", "Daniel", "David", "Dmitri", "Edward", "Eric", "Fernando", "Francesco", "George",
          "Giovanni", "Hans", "Henry", "Ivan", "James", "Jan", "Jean", "John", "Jonathan", "Jorge", "Joseph", "Juan",
          "Kenneth", "Kevin", "Klaus", "Lars", "Luis", "Marco", "Matthew", "Michael", "Miguel", "Mohammed", "Nicholas",
          "Patrick", "Paul", "Pedro", "Peter", "Pierre", "Piotr", "Richard", "Robert", "Ronald", "Sergei", "Stefan",
          "Stephen", "Steven", "Thomas", "Timothy", "Vladimir", "William", "Wolfgang"],
    "f": ["Agnieszka", "Alice", "Amanda", "Andrea", "Angela", "Anna", "Barbara", "Carmen", "Carolyn", "Catherine",
          "Christine", "Deborah", "Donna", "Dorothy", "Elena", "Elizabeth", "Emily", "Emma", "Fatima", "Hannah", "Helen",
          "Ingrid", "Isabel", "Jennifer", "Jessica", "Julia", "Karen", "Katarzyna", "Kimberly", "Laura", "Linda", "Lisa",
          "Lucia", "Margaret", "Maria", "Marie", "Mary", "Michelle", "Monika", "Nancy", "Natalia", "Nicole", "Olga",
          "Patricia", "Rachel", "Rebecca", "Ruth", "Sandra", "Sarah", "Sofia", "Sophie", "Stephanie", "Susan", "Svetlana",
          "Teresa", "Ursula", "Valentina", "Yolanda"],
}
#: Given names that are words as well: alone at a sentence's start they are
#: taken for the word (fixed values).
WORDS_TOO = {"angel", "april", "art", "august", "bill", "bob", "chance", "chase", "dawn", "drew", "earnest", "faith",
             "frank", "grace", "grant", "guy", "hope", "jack", "joy", "june", "mark", "may", "max", "miles", "pat",
             "pearl", "penny", "ray", "rich", "rob", "rose", "ruby", "sue", "summer", "violet", "will"}
_GIVEN = {n: g for g, names in GIVEN.items() for n in names}
_FIRST = "|".join(sorted(_GIVEN, key=len, reverse=True))
_GENDER = {t.lower(): g for g, titles in TITLES.items() for t in titles}
_TITLE = "|".join(sorted((re.escape(t) for ts in TITLES.values() for t in ts), key=len, reverse=True))
_NAME = r"[^\W\d_][^\W\d_'’-]*(?:[-'’][^\W\d_]+)*"
PATTERN = re.compile("|".join([
    r"(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)\b[\"']?\s*[:=]\s*)[\"']?(?P<secret>[^\s\"']{6,})",
    r"\b(?P<cloud>(?:AKIA|ASIA)[A-Z0-9]{16})\b",
    r"(?P<email>(?<![\w.+-])[\w.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)",
    r"\b(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b",
    r"(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
    r"|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
    r"|(?<![\w.,+-])0\d{2,4}[ -]\d{3,4}[ -]\d{3,4}(?![\w-]|[.,]\d))",
    r"(?P<card>(?<![\w-])[3-6](?:[ -]?\d){12,18}(?!\w))",
    rf"\b(?P<title>{_TITLE})\b\.? (?P<name>{_NAME}(?: {_NAME}){{0,2}})",
    rf"\b(?P<person>(?:{_FIRST})(?: [A-Z]\.)? {_NAME})",
    r"(?P<han>[一-鿿]{1,3})(?P<hantitle>先生|女士|小姐)",
]))
#: Texts that match none of this hold no entity (linear-time prefilter).
PREFILTER = (r"[0-9@]|AKIA|ASIA|(?i:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)|先生|女士|小姐|"
             rf"(?:^|[^\pL])(?:(?:{_TITLE})[. ]|(?:{_FIRST}) )")


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10


def _iban_valid(value: str) -> bool:
    flat = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def script_of(word: str) -> str:
    name = unicodedata.name(word[0], "LATIN") if word else "LATIN"
    return next((s for s in ("CYRILLIC", "GREEK", "CJK") if name.startswith(s)), "LATIN")


def _begins_sentence(text: str, at: int) -> bool:
    before = text[max(0, at - 4):at].rstrip(" \t\"'“”‘’(")
    return not before or before[-1] in ".!?…\n\r"


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, normal form) of every mention, in order, none
    overlapping.  The words of a name are also found where they stand alone;
    at a sentence's start a word is left that the text also has in lower case,
    or a given name out of ``WORDS_TOO``."""
    found, people, given = [], [], set()

    def person(begin: int, end: int, gender: str) -> None:
        words = [w for w in re.finditer(r"[^ ]+", text[begin:end]) if not w[0].endswith(".")]
        upper = next((k for k, w in enumerate(words) if not w[0][0].isupper()), len(words))
        words = words[:upper]
        if words and gender == "n":
            gender = _GIVEN.get(words[0][0], "n")
        people.extend((begin + w.start(), begin + w.end(), w[0], gender) for w in words)
        given.update(w[0] for w in words[:-1])

    at, size = 0, len(text)
    while at < size and (m := PATTERN.search(text, at)):
        at = m.end()
        kind = m.lastgroup
        if kind == "name":
            person(*m.span("name"), _GENDER[m["title"].lower()])
            continue
        if kind == "person":
            words = m["person"].split(" ")
            if words[-1][0].isupper():
                person(*m.span("person"), _GIVEN[words[0]])
            else:                      # the next word may begin a name of its own
                at = m.start() + len(words[0])
            continue
        if kind == "hantitle":
            word = m["han"]
            found.append((*m.span("han"), "name", f"{HAN_TITLES[m['hantitle']]}:{word}"))
            continue
        value = m[kind]
        if kind == "ip":
            if any(int(x) > 255 for x in value.split(".")):
                continue
            normal = ".".join(str(int(x)) for x in value.split("."))
        elif kind == "iban":
            if not _iban_valid(value):
                continue
            normal = value.replace(" ", "")
        elif kind == "email":
            normal = value.lower()
        elif kind in ("phone", "card", "ssn"):
            normal = _digits(value)
            if kind == "phone" and not 7 <= len(normal) <= 15:
                continue
            if kind == "phone" and value[0] == "+":      # country code, kept
                lead = 1 if normal[0] in "17" else 2
                normal = f"{normal[:lead]}:{normal[lead:]}"
            elif kind == "phone":
                normal = f":{normal}"
        else:
            normal = value
        found.append((*m.span(kind), kind, normal))
    if people:
        genders: dict[str, set[str]] = {}
        for _, _, word, gender in people:
            genders.setdefault(word.casefold(), set()).add(gender)
        normal_of = {}
        for _, _, word, _ in people:
            sure = genders[word.casefold()] - {"n"}
            normal_of[word] = f"{sure.copy().pop() if len(sure) == 1 else 'n'}:{word.casefold()}"
        found += [(begin, end, "name", normal_of[word]) for begin, end, word, _ in people]
        taken = {i for begin, end, _, _ in found for i in range(begin, end)}
        words = set(re.findall(r"[^\W\d_]+", text))
        alone = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(normal_of, key=len, reverse=True))) + r")(?!\w)")
        for m in alone.finditer(text):
            low = m[0].lower()
            word = low in words or (m[0] in given and low in WORDS_TOO)
            if m.start() not in taken and not (word and _begins_sentence(text, m.start())):
                found.append((m.start(), m.end(), "name", normal_of[m[0]]))
        found.sort()
    out, at = [], 0
    for mention in found:
        if mention[0] >= at:
            out.append(mention)
            at = mention[1]
    return out


class Draws:
    """A stream of keyed pseudo-random numbers."""

    def __init__(self, key: bytes, kind: str, normal: str, attempt: int):
        seed = f"{kind}\0{normal}\0{attempt}".encode()
        self.state = int.from_bytes(hashlib.blake2b(seed, key=key, digest_size=64).digest(), "big")
        self.more = lambda: int.from_bytes(hashlib.blake2b(
            self.state.to_bytes(64, "big"), key=key, digest_size=64).digest(), "big")
        self.left = self.state

    def below(self, n: int) -> int:
        if self.left < n << 64:
            self.state = self.left = self.more()
        self.left, out = divmod(self.left, n)
        return out

    def of(self, items: str) -> str:
        return items[self.below(len(items))]


_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS, _HEX = "0123456789", "0123456789abcdef"
#: Sound tables for invented names, by script: consonants, vowels, ends by
#: gender (fixed values).
SOUNDS = {
    "LATIN": ("bdfghklmnprstvwz", "aeiou", {"m": ["on", "us", "er", "in"], "f": ["a", "ia", "ine", "ela"],
                                            "n": ["el", "is", "ar", "en"]}),
    "CYRILLIC": ("бвгдзклмнпрстф", "аеиоу", {"m": ["ов", "ин", "ей", "ий"], "f": ["ова", "ина", "ая", "ия"],
                                             "n": ["ко", "ук", "ян", "их"]}),
    "GREEK": ("βγδζκλμνπρστφ", "αειου", {"m": ["ος", "ης", "ας", "ων"], "f": ["α", "η", "ια", "ου"],
                                         "n": ["ι", "ις", "ω", "ην"]}),
}
_HAN = {"m": "伟强军杰勇涛明超刚平", "f": "芳娜敏静丽艳娟霞秀燕", "n": "文华安宁云海山林月星"}
#: First and one past the last of all Han characters drawn from (fixed values).
_HAN_ALL = 0x4E00, 0x9FA6
_MARKS = "!#$%&*+-=?@^_~"


def _shape(draws: Draws, text: str) -> str:
    """Each character replaced within its class."""
    hexed = len(text) >= 8 and all(c in _HEX for c in text) and not text.isdigit()
    return "".join(draws.of(_HEX) if hexed else draws.of(_DIGITS) if c.isdigit() else
                   draws.of(_UPPER) if c.isupper() else draws.of(_LOWER) if c.isalpha() else c for c in text)


def surrogate(key: bytes, kind: str, normal: str, attempt: int) -> str:
    """The surrogate's normal form."""
    draws = Draws(key, kind, normal, attempt)
    # characters beyond the format's own: soon where the format is free, else
    # only when its space counts as used up
    free, more = "0" * (attempt // 2), "0" * (attempt // 8)
    if kind == "name":
        gender, word = normal.split(":", 1)
        script = script_of(word)
        if script == "CJK":            # later attempts: any characters, the last one by gender
            length = max(len(word), 2) + attempt // 4
            first, end = _HAN_ALL
            return "".join(chr(first + draws.below(end - first)) if attempt else draws.of(_HAN[gender])
                           for _ in range(length - 1)) + draws.of(_HAN[gender])
        consonants, vowels, ends = SOUNDS[script]
        syllables = 2 + attempt // 4 + draws.below(2)
        return "".join(draws.of(consonants) + draws.of(vowels) for _ in range(syllables)) + \
            draws.of(consonants) + ends[gender][draws.below(len(ends[gender]))]
    if kind == "email":
        local, domain = normal.rsplit("@", 1)
        labels = domain.split(".")
        reserved = labels[-2:] if len(labels) > 1 and labels[-2] == "example" else ["example", "com"]
        inner = labels[:-2] or labels[:1]
        return _shape(draws, local + free) + "@" + ".".join([*(_shape(draws, x) for x in inner), *reserved])
    if kind == "phone":
        lead, rest = normal.split(":")
        out = "".join(draws.of(_DIGITS) for _ in rest + more)
        if rest[:1] == "0":            # a trunk prefix stays
            out = "0" + draws.of("123456789") + out[2:]
        elif len(rest) == 10:          # area code and exchange never begin with 0 or 1
            fixed = rest[3:6] if rest[3:6] == "555" else draws.of("23456789") + out[4:6]
            out = draws.of("23456789") + out[1:3] + fixed + out[6:]
        return f"{lead}:{out}"
    if kind == "ip":
        first = 240 + draws.below(15) if attempt < 8 else 1 + draws.below(254)
        return ".".join(map(str, [first, draws.below(256), draws.below(256), 1 + draws.below(254),
                                  *(draws.below(256) for _ in range(attempt // 16))]))
    if kind == "card":
        body = normal[0] + "".join(draws.of(_DIGITS) for _ in normal[2:] + more)
        check = (10 - _luhn(body + "0")) % 10
        return body + str(check if _luhn(normal) == 0 else (check + 1 + draws.below(9)) % 10)
    if kind == "ssn":
        return "9" + "".join(draws.of(_DIGITS) for _ in normal[1:] + more)
    if kind == "iban":
        body = normal[:2] + "00" + _shape(draws, normal[4:] + more)
        check = 98 - int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97
        return f"{body[:2]}{check:02d}{body[4:]}"
    if kind == "cloud":
        return normal[:4] + "".join(draws.of(_UPPER + _DIGITS) for _ in normal[4:] + more)
    if not any(c.isdigit() or c.isalpha() for c in normal):
        return "".join(draws.of(_MARKS) for _ in normal + free)
    return _shape(draws, normal + free)


def written(kind: str, mention: str, normal: str) -> str:
    """The surrogate's normal form in the mention's own format."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(normal.replace(":", ""))
        return "".join([*(next(digits) if c.isdigit() else c for c in mention), *digits])
    if kind == "iban":
        chars = iter(normal)
        return "".join([*(c if c == " " else next(chars) for c in mention), *chars])
    if kind == "email":
        return "".join(c.upper() if i < len(mention) and mention[i].isupper() else c for i, c in enumerate(normal))
    if kind == "name":
        return normal.upper() if len(mention) > 1 and mention.isupper() else normal[:1].upper() + normal[1:]
    return normal


def replace_entities(text: str, key: bytes, attempts: dict[str, int]) -> tuple[str, int]:
    """The text with every mention replaced, and the number of mentions."""
    found = find_entities(text)
    parts, at = [], 0
    for begin, end, kind, normal in found:
        new = surrogate(key, kind, normal, attempts.get(f"{kind}\0{normal}", 0))
        parts += [text[at:begin], written(kind, text[begin:end], new)]
        at = end
    return "".join([*parts, text[at:]]), len(found)


def _flagged(part: pa.RecordBatch):
    return pa.compute.fill_null(pa.compute.match_substring_regex(part.column("text"), PREFILTER), False)


def _detect(batches):
    for batch in batches:
        seen = set()
        for text, digest in zip(*(x.to_pylist() for x in batch.filter(_flagged(batch)).select(["text", "digest"]).columns)):
            seen.update((digest, kind, normal) for _, _, kind, normal in find_entities(text))
        rows = sorted(seen)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)],
                                         ["digest", "kind", "normal"])


def _draw(key: bytes):
    def run(batches):
        for batch in batches:
            new = [surrogate(key, k, n, a) for k, n, a in zip(*(batch.column(c).to_pylist()
                                                                for c in ("kind", "normal", "attempt")))]
            yield batch.append_column("drawn", pa.array(new, pa.string()))
    return run


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, normal, attempt of the distinct entities that need another than
    the first draw."""
    shape = "kind string, normal string, attempt int, drawn string"
    todo = entities.withColumn("attempt", F.lit(0))
    real = entities.select("kind", F.when(F.col("kind") == "name", F.substring_index("normal", ":", -1)).otherwise(
        F.col("normal")).alias("drawn"))
    taken, moved = None, None
    while True:
        drawn = stage(todo.mapInArrow(_draw(key), shape), "drawn")
        best = drawn.groupBy("kind", "drawn").agg(F.min("normal").alias("normal"))
        # names share one range for all genders; other kinds compare normal forms
        free = best.join(real, ["kind", "drawn"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["kind", "drawn"], "left_anti")
        won = stage(drawn.join(free, ["kind", "drawn", "normal"], "left_semi"), "won")
        lost = drawn.join(won.select("kind", "normal"), ["kind", "normal"], "left_anti")
        taken = won.select("kind", "drawn") if taken is None else taken.unionByName(won.select("kind", "drawn"))
        late = won.where("attempt > 0").select("kind", "normal", "attempt")
        moved = late if moved is None else moved.unionByName(late)
        todo = lost.select("kind", "normal", (F.col("attempt") + 1).alias("attempt"))
        if todo.isEmpty():
            return moved


def _apply(key: bytes, names: list[str], text: str):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", 4 << 20):
                flags = _flagged(part).to_pylist()
                texts, moved = part.column("text").to_pylist(), part.column("moved").to_pylist()
                counts = [0] * len(texts)
                for i, flag in enumerate(flags):
                    if flag:
                        attempts = {e["entity"]: e["attempt"] for e in moved[i] or ()}
                        texts[i], counts[i] = replace_entities(texts[i], key, attempts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), part.column("row")],
                    ["text", "n_entities", "row"])
    return run


def session_key(spark) -> bytes:
    """The session setting's key, else a random one for this application."""
    given = spark.conf.get(KEY_SETTING, None)
    return given.encode() if given else _drawn_keys.setdefault(
        spark.sparkContext.applicationId, secrets.token_bytes(32))


def replace_personal_data(docs: DataFrame, key: bytes | None = None, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in its text column, and one more column,
    ``n_entities`` (mentions replaced; it takes the place of a column of that
    name).  The same key gives the same surrogates; without one it is
    ``session_key``."""
    prepare(docs.sparkSession)
    key = hashlib.sha256(key or session_key(docs.sparkSession)).digest()
    names = [c for c in docs.columns if c != "n_entities"]
    body = F.col(f"`{text}`")
    found = stage(docs.select(body.alias("text"), F.md5(body).alias("digest")).mapInArrow(
        _detect, "digest string, kind string, normal string"), "mentions")
    moved = stage(assign(stage(found.select("kind", "normal").distinct(), "entities"), key), "moved")
    entity = F.struct(F.concat_ws("\0", "kind", "normal").alias("entity"), "attempt")
    by_text = stage(found.join(moved, ["kind", "normal"]).groupBy("digest").agg(
        F.collect_set(entity).alias("moved")), "moved-texts")
    size = by_text.select(F.sum(F.octet_length(F.to_json("moved")) + 64)).first()[0] or 0
    rows = docs.select(body.alias("text"), F.md5(body).alias("digest"), F.struct(
        *[F.col(f"`{c}`") for c in names if c != text] or [F.lit(0).alias("none")]).alias("row"))
    rows = rows.join(F.broadcast(by_text) if size <= BROADCAST_BYTES else by_text, "digest", "left")
    row_type = rows.schema["row"].dataType.simpleString()
    out = rows.select("text", "moved", "row").mapInArrow(
        _apply(key, names, text), f"text string, n_entities long, row {row_type}")
    return out.select(*[F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in names],
                      "n_entities")
