"""Personal data replaced by keyed surrogates.

Found are e-mail addresses, telephone, card and account numbers, IPv4 addresses, social security numbers,
secrets (values named as such, access keys, long hexadecimal tokens) and names after a form of address.
Every entity is reduced to a key (lower case, or digits only; a name word by word), and the surrogate of a key
depends on nothing but a secret, the type, the key and a number of attempts: the same entity gets the same
surrogate in every document, however it is written. A surrogate has the type, lengths, separators, case and
script of what it stands for, cards keep a valid check digit. Given names have the gender that most texts of the
corpus which name them with a form of address give them, if any does; a text's own form of address does not make it
another name.

A name found after a form of address is replaced wherever the same text has it as a whole word again, with or without
a form of address. Names that no form of address precedes anywhere in a text are not found.

Two entities may not share a surrogate and no surrogate may be an entity of the corpus. Spark looks for such
collisions over all distinct entities; the losers try again until none is left. Texts with an entity that
needed another attempt get their attempts by a join on the text's hash; all others need no join at all.

Null texts stay null. Text without entities is left as it is. Repeated rows are replaced alike. An empty table gives
no rows. Very long texts are read whole. Where genders tie, the key decides. A secret or an address without any letter or digit to
replace, such as a masked one, is no entity.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import free_name, in_arrow, small, stage

MOST_ATTEMPTS = 40
#: Draws for one surrogate before it is an error; a draw is the key itself once in ten times at most.
MOST_DRAWS = 1000

# Forms of address by gender, and names to stand for names.
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Sra", "Srta", "Señora", "Madame", "Госпожа")
MALE_TITLES = ("Mr", "Herr", "Sr", "Señor", "Monsieur", "Mister", "Господин")
OPEN_TITLES = ("Dr", "Prof", "Mx")
NAMES = {
    ("latin", "f"): "Alma Berta Clara Dora Elsa Flora Greta Hilda Irma Julia Karla Lena Mona Nora Olga Paula Rosa Sara Tilda Vera",
    ("latin", "m"): "Albin Bruno Carlo Diego Emil Fabio Georg Hugo Ivo Jonas Karl Leon Marco Nils Otto Pablo Rolf Sven Theo Viktor",
    ("latin", "s"): "Abel Berg Castell Dorn Ebner Falk Garten Hold Imhof Janke Kern Lund Moser Nolte Orth Perl Rast Sommer Thal Wald",
    ("cyrillic", "f"): "Алла Вера Галина Дина Елена Жанна Зоя Инна Кира Лида Мария Нина Ольга Раиса Софья Тамара",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Степан",
    ("greek", "f"): "Αγνή Δάφνη Ελένη Ζωή Ηλέκτρα Θάλεια Ιόλη Κλειώ Λυδία Μυρτώ Νίκη Ξένια Όλγα Ρέα Φαίδρα Χλόη",
    ("greek", "m"): "Άρης Βίκτωρ Γιάννης Δήμος Ερμής Ζήνων Ηλίας Θωμάς Κίμων Λέων Μάριος Νίκος Ορέστης Πέτρος Σπύρος Φώτης",
    ("greek", "s"): "Αγγελής Βλάχος Γαλάνης Δούκας Ζέρβας Θάνος Κάππας Λάσκαρης Μάρκου Νάκος Πάλλης Ράλλης Σάββας Τζίμας",
    ("cyrillic", "s"): "Агапов Белов Волков Громов Дроздов Ежов Жуков Зимин Исаев Котов Лапин Мохов Носов Орлов Попов Рогов",
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi ga go ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi",
    "greek": "βα βε γα γο δα δε ζα ζω θα θε κα κο λα λε μα με να νο πα πε ρα ρο σα σε τα το φα φε",
    "cyrillic": "ба бе би бо ва ве ви га го да де ди за зо ка ки ко ла ле ли ма ми мо на не ни ра ре ри са се си та те ти",
}

#: First and last small letter of alphabets whose letters are replaced by their own.
ALPHABETS = {"greek": "αω", "cyrillic": "ая", "armenian": "աֆ", "georgian": "აჰ", "hebrew": "את", "arabic": "بي", "devanagari": "अह", "kana": "あん", "hangul": "가힣", "han": "一龥"}

_TITLE = "|".join(sorted(FEMALE_TITLES + MALE_TITLES + OPEN_TITLES, key=len, reverse=True))
_NAME = re.compile(rf"(?<!\w)({_TITLE})\.?[  ]((?:[^\W\d_a-z][\w'’-]+)(?:[  ][^\W\d_a-z][\w'’-]+){{0,2}})")
_LOCAL = re.compile(r"[\w.+%-]{1,64}$")
_DOMAIN = re.compile(r"(?:[\w-]{1,63}\.){1,8}[^\W\d_]{2,24}")
_SECRET = re.compile(r"(?i)(?<!\w)(?:pass(?:word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key)[ \t]*[=:][ \t]*[\"']?([^\s\"']{8,})")
_ACCESS = re.compile(r"(?<!\w)(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w)|(?<!\w)(?:ghp|gho|sk|pk|xoxb)[_-][\w-]{16,}")
_KEPT = re.compile(r"AKIA|ASIA|(?:ghp|gho|sk|pk|xoxb)[_-]")
_HEX = re.compile(r"(?<!\w)(?=[0-9a-f]*\d)(?=[0-9a-f]*[a-f])[0-9a-f]{32,128}(?!\w)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)")
_DIGITS = re.compile(r"(?<![\w.,])[+(]?\d[\d ().\-/]{5,28}\d(?![\w@])")
_IP = re.compile(r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)$")
_CARD = re.compile(r"\d(?:[ -]?\d){12,18}$")
_SSN = re.compile(r"\d{3}-\d{2}-\d{4}$")
_PHONE = re.compile(r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}$|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}$|\d{3}[.-]\d{3}[.-]\d{4}$")
_WORD = re.compile(r"\w+(?:['’-]\w+)*")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def _number(text: str) -> str | None:
    if _IP.match(text):
        return "ip"
    if _SSN.match(text):
        return "ssn"
    if _PHONE.match(text):
        return "phone"
    if _CARD.match(text):
        return "card"
    return None


def find(text: str) -> list[tuple[int, int, str]]:
    """Spans and types of the entities of a text, in order and without overlap; the earlier type below wins."""
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        at = text.find("@")
        while at >= 0:
            local, domain = _LOCAL.search(text, max(0, at - 64), at), _DOMAIN.match(text, at + 1)
            if local and domain and _replaceable(local.group() + domain.group().rpartition(".")[0]):
                found.append((local.start(), domain.end(), "email"))
            at = text.find("@", at + 1)
    if "=" in text or ":" in text:
        found += [(*m.span(1), "secret") for m in _SECRET.finditer(text) if _replaceable(m.group(1)[_kept(m.group(1)) :])]
    found += [(*m.span(), "secret") for m in _ACCESS.finditer(text) if _replaceable(m.group()[_kept(m.group()) :])] if _any(text, ("AKIA", "ASIA", "gh", "sk", "pk", "xoxb")) else []
    if any(d in text for d in "0123456789"):
        found += [(*m.span(), "secret") for m in _HEX.finditer(text)]
        found += [(*m.span(), "iban") for m in _IBAN.finditer(text)]
        for m in _DIGITS.finditer(text):
            if kind := _number(m.group()):
                found.append((*m.span(), kind))
            else:  # two numbers side by side
                place = m.start()
                for part in re.split(r"(?<=\d) (?=[+(]?\d)", m.group()):
                    if kind := _number(part):
                        found.append((place, place + len(part), kind))
                    place += len(part) + 1
    if _any(text, FEMALE_TITLES + MALE_TITLES + OPEN_TITLES):
        found += _names(text)
    out, end = [], 0
    order = {k: i for i, k in enumerate(("email", "secret", "iban", "ip", "ssn", "phone", "card"))}
    for span in sorted(found, key=lambda s: (s[0], order.get(s[2], 9), -s[1])):
        if span[0] >= end:
            out.append(span)
            end = span[1]
    return out


def _names(text: str) -> list[tuple[int, int, str]]:
    """Names after a form of address, and their words wherever else they stand; one gender for each given name."""
    first: list[tuple[int, int, str]] = []
    genders: dict[str, str] = {}
    for m in _NAME.finditer(text):
        words = list(_WORD.finditer(text, *m.span(2)))
        gender = "f" if m.group(1) in FEMALE_TITLES else "m" if m.group(1) in MALE_TITLES else "x"
        for k, w in enumerate(words):
            first.append((*w.span(), "surname" if k == len(words) - 1 else "given"))
            if k < len(words) - 1 and genders.get(w.group().lower(), "x") == "x":
                genders[w.group().lower()] = gender
    kinds: dict[str, str] = {}
    for a, b, kind in first:
        if b - a > 1:
            kinds.setdefault(text[a:b], kind)
    taken = {a for a, _, _ in first}
    if kinds:
        again = (m for m in _WORD.finditer(text) if m.start() not in taken)
        for m in again:
            if m.group() in kinds:
                first.append((*m.span(), kinds[m.group()]))
            elif "-" in m.group() or "'" in m.group() or "’" in m.group():  # a possessive, or joined to another word
                for part in re.finditer(r"\w+", m.group()):
                    if part.group() in kinds:
                        first.append((m.start() + part.start(), m.start() + part.end(), kinds[part.group()]))
    return [(a, b, f"given_{genders.get(text[a:b].lower(), 'x')}" if kind == "given" else kind) for a, b, kind in first]


def _any(text: str, parts: tuple[str, ...]) -> bool:
    return any(p in text for p in parts)


def _kept(secret: str) -> int:
    """The length of the prefix that names the kind of a key and stays."""
    prefix = _KEPT.match(secret)
    return prefix.end() if prefix else 0


def _replaceable(text: str) -> bool:
    """Whether ``_like`` can make another text of it."""
    return any(c.isdigit() or c.isalpha() for c in text)


def key_of(kind: str, mention: str) -> str:
    """What stays the same however an entity is written."""
    if kind in ("phone", "card", "ssn"):
        return "".join(c for c in mention if c.isdigit())
    if kind == "iban":
        return mention.replace(" ", "").upper()
    return mention if kind in ("secret", "ip") else mention.lower()


class Draws:
    """Numbers drawn from a keyed hash."""

    def __init__(self, secret: bytes, *parts: str):
        self.secret, self.message, self.block, self.rest = secret, "\x1f".join(parts).encode(), 0, 0
        self.bits = 0

    def below(self, n: int) -> int:
        if self.bits < 32:
            digest = hmac.new(self.secret, self.message + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.rest, self.bits, self.block = int.from_bytes(digest, "big"), 256, self.block + 1
        value = self.rest & 0xFFFFFFFF
        self.rest >>= 32
        self.bits -= 32
        return value % n


def _like(text: str, draws: Draws) -> str:
    """Another text of the same letter cases, digits and separators."""
    hexadecimal = len(text) >= 16 and not text.isdigit() and all(c in "0123456789abcdef" for c in text)
    out = []
    for c in text:
        if hexadecimal:
            out.append("0123456789abcdef"[draws.below(16)])
        elif c.isdigit():
            out.append("0123456789"[draws.below(10)])
        elif c.isalpha():
            low, high = ALPHABETS.get(_script(c), "az")
            made = chr(ord(low) + draws.below(ord(high) - ord(low) + 1))
            while not made.isalpha() or made == "ς":
                made = chr(ord(low) + draws.below(ord(high) - ord(low) + 1))
            out.append(made.upper() if c.isupper() else made)
        else:
            out.append(c)
    return "".join(out)


def _script(word: str) -> str:
    """The script of the first letter that is of one of ``ALPHABETS``; else latin."""
    if word.isascii():
        return "latin"
    for c in word:
        for block, script in _BLOCKS:
            if ord(c) < block:
                break
            if ord(c) <= block + script[1]:
                return script[0]
    return "latin"


# First code point of a script's block, its name, and the length of the block.
_BLOCKS = (
    (0x0370, ("greek", 0x8F)),
    (0x0400, ("cyrillic", 0x12F)),
    (0x0530, ("armenian", 0x5F)),
    (0x0590, ("hebrew", 0x6F)),
    (0x0600, ("arabic", 0xFF)),
    (0x0900, ("devanagari", 0x7F)),
    (0x10D0, ("georgian", 0x2F)),
    (0x3040, ("kana", 0xBF)),
    (0x4E00, ("han", 0x51FF)),
    (0xAC00, ("hangul", 0x2BAF)),
)


def surrogate(kind: str, key: str, attempt: int, secret: bytes) -> str:
    """The key of the surrogate of an entity's key. It never is the key itself."""
    draws = Draws(secret, kind, key, str(attempt))
    for _ in range(MOST_DRAWS):
        made = _surrogate(kind, key, draws, attempt)
        if made != key:
            return made
    raise ValueError(f"a {kind} without anything to replace")


def _surrogate(kind: str, key: str, draws: Draws, attempt: int) -> str:
    if kind == "email":
        local, _, domain = key.partition("@")
        *labels, top = domain.split(".")
        return f"{_like(local, draws)}@{'.'.join(_like(x, draws) for x in labels)}.{top}"
    if kind == "ip":
        return ".".join(str(1 + draws.below(254)) for _ in range(4))
    if kind == "card":
        body = key[0] + _like(key[1:-1], draws)
        return body + next((d for d in "0123456789" if luhn(body + d) == luhn(key)))
    if kind == "phone":
        # Country and service digits stay, so the number remains of its kind.
        keep = 1 if len(key) <= 11 else 2
        return key[:keep] + str(2 + draws.below(8)) + _like(key[keep + 1 :], draws)
    if kind == "ssn":
        return f"{1 + draws.below(899):03d}" + _like(key[3:], draws)
    if kind == "iban":
        body = _like(key[4:], draws)
        number = "".join(str(int(c, 36)) for c in body + key[:2]) + "00"
        return key[:2] + f"{98 - int(number) % 97:02d}" + body
    if kind == "secret":
        start = _kept(key)
        return key[:start] + _like(key[start:], draws)
    script = _script(key)
    if script not in SYLLABLES:
        return _like(key, draws)
    names = NAMES[script, "s" if kind == "surname" else {"f": "f", "m": "m", "x": "fm"[draws.below(2)]}[kind[-1]]].split()
    made = names[draws.below(len(names))].lower()
    syllables = SYLLABLES[script].split()
    # The lists are short and corpora are not: most names get syllables of their own.
    return made + "".join(syllables[draws.below(len(syllables))] for _ in range(2 + attempt // 4)) if kind == "surname" else (
        made if attempt < 2 else made[:-1] + "".join(syllables[draws.below(len(syllables))] for _ in range(1 + attempt // 4))
    )


def render(kind: str, mention: str, made: str) -> str:
    """A surrogate key written the way the mention is."""
    if kind in ("phone", "card", "ssn", "iban"):
        chars = iter(made)
        return "".join(next(chars) if c.isalnum() else c for c in mention)
    if kind in ("secret", "ip"):
        return made
    if mention.isupper():
        return made.upper()
    return made[:1].upper() + made[1:] if mention[:1].isupper() else made


def _text_hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        rows = set()
        for text in batch.column(0).to_pylist():
            if text and (spans := find(text)):
                key = _text_hash(text)
                for a, b, kind in spans:
                    base, _, gender = kind.partition("_")
                    rows.add((key, base, key_of(kind, text[a:b]), gender))
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string())
        names = ["text_hash", "kind", "entity", "gender"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def gendered(mentions: DataFrame) -> DataFrame:
    """kind, entity, gender of each distinct entity: that of most mentions, ``x`` where they tie, empty for no name."""
    side = F.sum(F.when(F.col("gender") == "f", 1).when(F.col("gender") == "m", -1).otherwise(0))
    gender = F.when(F.max("gender") == "", "").when(side > 0, "f").when(side < 0, "m").otherwise("x")
    return mentions.groupBy("kind", "entity").agg(gender.alias("gender"))


def assign(entities: DataFrame, secret: bytes) -> DataFrame:
    """kind, entity, gender, attempt, made: a surrogate for each (kind, entity), all different and no entity.

    ``entities`` (kind, entity, gender) are distinct in kind and entity."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            kind, entity, gender, attempt = (c.to_pylist() for c in batch.columns)
            made = [surrogate(f"{k}_{g}" if g else k, e, n, secret) for k, e, g, n in zip(kind, entity, gender, attempt)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())], ["kind", "entity", "gender", "attempt", "made"]
            )

    schema = "kind string, entity string, gender string, attempt int, made string"
    known = stage(in_arrow(entities.withColumn("attempt", F.lit(0)), make, schema), "surrogates")
    real = known.select("kind", F.col("entity").alias("made"))
    for _ in range(MOST_ATTEMPTS):
        # Of those that made the same, one that has kept it for the most attempts goes on with it.
        first = known.groupBy("kind", "made").agg(
            F.count("*").alias("n"), F.max_by("entity", F.struct("attempt", "entity")).alias("owner")
        )
        shared = first.where("n > 1").select("kind", "made", "owner")
        losers = known.join(shared, ["kind", "made"]).where("entity <> owner").select("kind", "entity")
        taken = known.join(real, ["kind", "made"], "left_semi").select("kind", "entity")
        again = stage(losers.union(taken).distinct(), "again")
        if again.isEmpty():
            return known
        kept = known.join(again, ["kind", "entity"], "left_anti")
        retried = known.join(again, ["kind", "entity"], "left_semi").select(
            "kind", "entity", "gender", (F.col("attempt") + 1).alias("attempt")
        )
        known = stage(kept.union(in_arrow(retried, make, schema)), "surrogates")
    raise RuntimeError(f"surrogates still collide after {MOST_ATTEMPTS} attempts")


def replace(docs: DataFrame, secret: bytes, count_column: str | None = None) -> DataFrame:
    """``docs`` with the entities of column ``text`` replaced; ``count_column`` adds their number (0 if none).

    A column n_chars is kept true to the new text. Other columns stay; one named as ``count_column`` is replaced.
    """
    if count_column:
        docs = docs.drop(count_column)
    texts = docs.select(F.col("text").cast("string"))
    mentions = stage(in_arrow(texts, _mentions, "text_hash bigint, kind string, entity string, gender string"), "mentions")
    surrogates = assign(gendered(mentions), secret)
    # Mentions for which the text itself does not tell the surrogate.
    whole = surrogates.select("kind", "entity", F.col("gender").alias("agreed"), "attempt", "made")
    later = stage(mentions.join(whole, ["kind", "entity"]).where("attempt > 0 or gender <> agreed"), "later")
    apart = free_name(docs, "later")
    if later.isEmpty():
        joined = docs.withColumn(apart, F.lit(None).cast("array<struct<kind:string,entity:string,made:string>>"))
    else:
        hashed = free_name(docs, "text_hash")
        by_text = later.groupBy(F.col("text_hash").alias(hashed)).agg(
            F.collect_set(F.struct("kind", "entity", "made")).alias(apart)
        )
        joined = docs.withColumn(hashed, _hash_column("text")).join(by_text, hashed, "left").select(*docs.columns, apart)
    place = docs.columns.index("text")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out, counts = [], []
            for text, exceptions in zip(batch.column(place).to_pylist(), batch.column(len(batch.columns) - 1).to_pylist()):
                spans = find(text) if text else []
                counts.append(len(spans))
                if spans:
                    special = {(e["kind"], e["entity"]): e["made"] for e in exceptions or ()}
                    parts, end = [], 0
                    for a, b, kind in spans:
                        key = key_of(kind, text[a:b])
                        made = special.get((kind.partition("_")[0], key)) or surrogate(kind, key, 0, secret)
                        parts += [text[end:a], render(kind, text[a:b], made)]
                        end = b
                    text = "".join([*parts, text[end:]])
                out.append(text)
            columns = batch.columns[:-1]
            columns[place] = pa.array(out, pa.string())
            if count_column:
                columns.append(pa.array(counts, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [*docs.columns, *([count_column] if count_column else [])]
    fields = [f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema.fields]
    schema = ", ".join([*fields, *([f"{count_column} int"] if count_column else [])])
    done = in_arrow(joined.withColumn("text", F.col("text").cast("string")), rewrite, schema)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done


def _hash_column(name: str):
    @F.pandas_udf("bigint")
    def hashed(text: pd.Series) -> pd.Series:
        return text.map(lambda t: _text_hash(t) if t else 0)

    return hashed(F.col(name).cast("string"))
