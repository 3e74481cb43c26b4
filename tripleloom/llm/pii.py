"""Personal data: detected entities get keyed surrogates of their own type and format.

Numbers go through keyed Feistel permutations of the numbers of their length and class. Names,
mailboxes and secrets are drawn by a keyed digest. Which surrogates would meet, or would equal an
entity of the corpus, is checked over all entities; the losers draw again, and only their numbers of
draws are sent along. From the draw LAST on a surrogate carries digits of a keyed digest beside its
format, so that drawing ends. An entity has one surrogate wherever it occurs. Of a person's name every part is
an entity, so that later mentions by a part of it have the same family and given name.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import drop_stage, free_name, prepare, shuffle_parts, stage

#: The session's setting that holds the secret key, as text.
KEY_SETTING = "spark.tripleloom.pii.key"
#: Entities that drew more than once are broadcast up to this number, else joined.
MOST_SENT = 200_000
#: Entities that a task draws for: few bytes, but much work.
DRAW_ROWS = 20_000
#: The draw from which on surrogates carry digits of a digest, and rounds of drawing after which there is an error.
LAST, MOST_ROUNDS = 8, 40

# fixed values: patterns of what is detected
EMAIL = regex.compile(r"\w[\w.+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}")
SECRET = regex.compile(r"(?i)(?<![a-z])(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|secret[_-]?key|пароль)[\"']?\s*[=:]\s*")
QUOTED = regex.compile(r"[\"']([^\"'\s]{6,})(?=[\"'])")
BARE = regex.compile(r"(?=[^\s\"',;<>]*[\d_@#$%^&*+=~])([^\s\"',;<>(){}]{6,}?)(?=[.!?]?(?:[\s\"',;<>(){}]|$))")
IPV6 = regex.compile(r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])")
KEY_FORMS = regex.compile(r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|[0-9a-f]{40}|[0-9A-F]{40}|[0-9a-f]{64})(?![A-Za-z0-9])")
IBAN = regex.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NUMBERS = {
    "ip": regex.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"),
    "ssn": regex.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "card": regex.compile(r"(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d-])"),
    "phone": regex.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,5}\)[ .-]?|\d{2,5}[ .-])(?:\d{2,4}[ .-]?){1,4}\d{2}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"),
}
TITLES = {
    "f": "Mrs Ms Miss Mme Madame Frau Sra Señora Signora Lady г-жа госпожа κυρία".split(),
    "m": "Mr Herr Monsieur Señor Signor Sir г-н господин κύριος".split(),
    "n": "Dr Prof Professor".split(),
}
GIVEN = {
    ("latin", "f"): "Alma Berta Clara Dora Elena Flora Greta Helena Irma Julia Karla Lena Maria Nora Olga Paula Rosa Sara Thea Vera".split(),
    ("latin", "m"): "Albert Bruno Carl Daniel Emil Felix Georg Henri Ivan Jonas Karl Leo Martin Nils Oscar Paul Robert Simon Theo Viktor".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Зоя Ирина Мария Нина Ольга".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Иван Кирилл Лев Максим Павел".split(),
    ("greek", "f"): "Άννα Βασιλική Γεωργία Ελένη Ιωάννα Κατερίνα Μαρία Σοφία".split(),
    ("greek", "m"): "Αλέξανδρος Βασίλης Γιώργος Δημήτρης Κώστας Νίκος Πέτρος Σπύρος".split(),
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga ge ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi vo".split(),
    "cyrillic": "ба бе ва ве га да де за зе ка ке ла ле ма ме на не па ра ре са се та те".split(),
    "greek": "βα βε γα γε δα δε κα κε λα λε μα με να νε πα ρα ρε σα σε τα τε".split(),
}
#: Endings of given names that are made when the list has none left.
ENDINGS = {("latin", "f"): "na", ("latin", "m"): "no", ("cyrillic", "f"): "на", ("cyrillic", "m"): "н", ("greek", "f"): "να", ("greek", "m"): "νος"}
#: What stands before a name without a title.
CUES = "Name Contact From Signed Author Имя Контакт Όνομα Nom Nombre".split()
_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_PART = r"\p{Lu}[\p{L}\p{M}'’-]*[\p{L}\p{M}]"
_NAME = regex.compile(rf"(?<!\p{{L}})(?:({'|'.join(sorted(_GENDER, key=len, reverse=True))})\.? ({_PART}(?: {_PART}){{0,2}})|(?:{'|'.join(CUES)}): *({_PART}(?: {_PART}){{1,2}}))")
_CALLED = [t + end for t in _GENDER for end in (" ", ". ")] + [f"{c}:" for c in CUES]
_CAPITALISED = regex.compile(rf"(?<![\p{{L}}\p{{M}}\p{{N}}_]){_PART}(?![\p{{L}}\p{{M}}\p{{N}}_])")
_LOWER = regex.compile(r"(?<![\p{L}\p{M}])\p{Ll}[\p{L}\p{M}]*")
_GENITIVE = regex.compile(r"['’]s$")
_NUMERIC = re.compile(r"[0-9+(]")


def luhn(digits: str) -> int:
    """The check sum of a card number: 0 if it is valid."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10


def _script(text: str) -> str:
    if regex.search(r"\p{Cyrillic}", text):
        return "cyrillic"
    return "greek" if regex.search(r"\p{Greek}", text) else "latin"


def _candidates(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of what has an entity's form. Each kind is only tried where its mark stands."""
    at = text.find("@")
    while at >= 0:
        start = at
        while start and (text[start - 1].isalnum() or text[start - 1] in "_.+-"):
            start -= 1
        while start < at and not (text[start].isalnum() or text[start] == "_"):
            start += 1
        end = at + 1
        if m := EMAIL.match(text, start):
            end = m.end()
            yield start, end, "email"
        at = text.find("@", end)
    if "=" in text or ":" in text:
        for m in SECRET.finditer(text):
            if k := QUOTED.match(text, m.end()) or BARE.match(text, m.end()):
                yield *k.span(1), "secret"
        if text.count(":") > 1:
            for m in IPV6.finditer(text):
                yield *m.span(), "ipv6"
    done = done_key = 0
    for m in _NUMERIC.finditer(text):
        at = m.start()
        if at >= done_key and "0" <= text[at] <= "9":
            start = at
            while start and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "_-"):
                start -= 1
            done_key = at + 1
            for s in {start, at - 2} if at >= 2 and text[at - 2 : at].isupper() else {start}:
                if s == 0 or not text[s - 1].isalnum():
                    if k := KEY_FORMS.match(text, s):
                        yield s, k.end(), "secret"
                        done_key = k.end()
                    elif k := IBAN.match(text, s):
                        yield s, k.end(), "iban"
                        done_key = k.end()
        if at >= done:
            for kind, pattern in NUMBERS.items():
                if (k := pattern.match(text, at)) and _sound(kind, k[0]):
                    yield at, k.end(), kind
                    done = k.end()
                    break
    if any(t in text for t in _CALLED):
        yield from _names(text)


def _sound(kind: str, value: str) -> bool:
    """Whether a number may be what its form says: check digits of cards, areas of social security numbers."""
    if kind == "card":
        digits = [c for c in value if c.isdigit()]
        return luhn("".join(digits)) == 0 and len(set(digits)) > 1
    if kind == "ssn":
        area, group, serial = value.split("-")
        return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
    return True


def _names(text: str) -> Iterator[tuple[int, int, str]]:
    """The parts of names that stand after a title or a cue, and all other mentions of these parts in the text.

    The last part is the family. A given name has the gender of the person's title; without one, that of
    another mention in the text, else none. A part that the text also has as a word in lower case is only
    taken where it stands after a title or a cue.
    """
    known: dict[str, str] = {}
    named = []
    for m in _NAME.finditer(text):
        named.append(m.span(2) if m[2] else m.span(3))
        parts = _GENITIVE.sub("", m[2] or m[3]).split(" ")
        known.setdefault(parts[-1], "name-family")
        for x in parts[:-1]:
            kind = f"name-given-{_GENDER[m[1]] if m[1] else 'n'}"
            if known.get(x, "").endswith("-n") or x not in known:
                known[x] = kind
    if not known:
        return
    plain = set(_LOWER.findall(text))
    common = {x for x in known if x.lower() in plain}
    at = 0
    for m in _CAPITALISED.finditer(text):
        x = m[0] if m[0] in known else _GENITIVE.sub("", m[0])
        if x in known:
            while at < len(named) and named[at][1] <= m.start():
                at += 1
            if x not in common or at < len(named) and named[at][0] <= m.start():
                yield m.start(), m.start() + len(x), known[x]


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the entities, from left to right, without overlaps.

    Of overlapping ones the first stays, of those the longest. The canonical form is what counts as
    the same entity: digits without their separators, mail addresses in lower case. A name is found by
    its parts; a given name's kind carries the gender of its title. Cards must have a valid check digit.
    """
    out, last = [], 0
    for a, b, kind in sorted(_candidates(text or ""), key=lambda x: (x[0], -x[1])):
        if a < last:
            continue
        value, last = text[a:b], b
        if kind in ("email", "ipv6"):
            value = value.lower()
        elif kind in ("card", "phone", "ssn"):
            value = "".join(c for c in value if "0" <= c <= "9" or c == "+")
        elif kind == "iban":
            value = value.replace(" ", "")
        out.append((a, b, kind, value))
    return out


class Surrogates:
    """Keyed surrogates; ``draw`` numbers the attempts for one entity."""

    def __init__(self, key: bytes) -> None:
        self.key = key
        self.known = lru_cache(maxsize=1 << 16)(self._make)

    def _stream(self, *parts: object) -> int:
        return int.from_bytes(hmac.new(self.key, "\0".join(map(str, parts)).encode(), hashlib.sha256).digest(), "big")

    def permute(self, domain: str, x: int, size: int) -> int:
        """A keyed permutation of 0 .. size - 1: Feistel rounds, walked until inside."""
        half = max(1, (max(2, size) - 1).bit_length() + 1 >> 1)
        mask = (1 << half) - 1
        while True:
            left, right = x >> half, x & mask
            for r in range(6):
                left, right = right, left ^ (self._stream("feistel", domain, r, right) & mask)
            x = left << half | right
            if x < size:
                return x

    def digits(self, domain: str, value: str, good=None) -> str:
        """Permuted digits of the same length; ``good`` is a property that stays as it is."""
        size, x, want = 10 ** len(value), int(value), good(value) if good else None
        while True:
            x = self.permute(f"{domain}{len(value)}", x, size)
            out = str(x).zfill(len(value))
            if good is None or good(out) == want:
                return out

    def _word(self, script: str, seed: int, length: int) -> str:
        syllables = SYLLABLES[script]
        out = []
        while sum(map(len, out)) < length:
            seed, i = divmod(seed, len(syllables))
            out.append(syllables[i])
        return "".join(out)

    def _make(self, kind: str, value: str, draw: int) -> str:
        made = self._formed(kind, value, draw)
        if draw < LAST:
            return made
        # too many draws for the format: digits that no other entity has
        if kind.startswith("name"):
            return made + self._word(_script(value), self._stream("more", kind, value, draw), 24)
        more = self._stream("more", kind, value, draw) % 10**24
        if kind == "email":
            return made.replace("@", f".{more:024d}@")
        if kind in ("ip", "ipv6"):
            return "2001:db8:" + ":".join(f"{more >> 16 * i & 0xFFFF:x}" for i in range(6))
        return f"{made}{more:024d}"

    def _formed(self, kind: str, value: str, draw: int) -> str:
        domain = f"{kind}/{draw}" if draw else kind
        if kind == "card":
            return self.digits(domain, value, lambda x: luhn(x) == 0)
        if kind == "ssn":
            return self.digits(domain, value)
        if kind == "phone":
            # the country code stays, or the two digits that it begins with
            stem = 0 if value[0] != "+" else 2 if value[1] in "17" else 3
            return value[:stem] + self.digits(domain + value[:stem], value[stem:])
        if kind == "ip":
            x = 0
            for part in value.split("."):
                x = x << 8 | int(part)
            x = self.permute(domain, x, 1 << 32)
            return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))
        if kind == "iban":
            body = self._like(kind, value[4:], draw)
            return value[:2] + (f"{98 - _mod97(value[:2] + '00' + body):02d}" if _mod97(value) == 1 else self._like("check", value[2:4], draw)) + body
        seed = self._stream(kind, value, draw)
        if kind == "email":
            local, _, host = value.partition("@")
            name = self._word("latin", seed, max(10, len(local) - 3))
            return f"{name}.{seed % 97:02d}@{self._word('latin', self._stream('host', host), 10)}.example.{host.rsplit('.', 1)[1]}"
        if kind == "name-family":
            return self._word(_script(value), seed, max(8, len(value)) + draw).capitalize()
        if kind.startswith("name"):
            script, gender = _script(value), kind[-1]
            if gender == "n":
                gender = "fm"[seed & 1]
            names = GIVEN[script, gender]
            return names[(seed >> 8) % len(names)] if draw < 2 else self._word(script, seed >> 8, 2 + 2 * draw).capitalize() + ENDINGS[script, gender]
        if kind == "ipv6":
            return ":".join(f"{seed >> 16 * i & 0xFFFF:x}" if x else x for i, x in enumerate(value.split(":")))
        return self._like(kind, value, draw)

    def _like(self, kind: str, value: str, draw: int) -> str:
        """Other characters of the same classes, whatever their script; a known prefix stays."""
        stem = regex.match(r"AKIA|gh[pousr]_|sk-|", value)[0] if kind == "secret" else ""
        rest = value[len(stem) :]
        hexed = regex.fullmatch(r"[0-9a-f]{16,}|[0-9A-F]{16,}", rest) is not None and not rest.isdigit()
        stream, out = 0, [stem]
        for i, c in enumerate(rest):
            if i % 16 == 0:
                stream = self._stream("like", kind, value, draw, i)
            stream, low = divmod(stream, 65536)
            choice = ("0123456789abcdef" if rest == rest.lower() else "0123456789ABCDEF") if hexed else alike(c)
            out.append(choice[low % len(choice)])
        return "".join(out)

    def __call__(self, kind: str, value: str, draw: int, original: str) -> str:
        """The surrogate in the format of one occurrence: separators and capitals as there."""
        made = self.known(kind, value, draw)
        if kind in ("card", "phone", "ssn", "iban"):
            symbols = iter(made)
            return "".join([next(symbols) if c.isalnum() or c == "+" else c for c in original] + list(symbols))
        return made.upper() if kind == "email" and original.isupper() else made


@cache
def alike(c: str) -> str:
    """The characters that may stand for ``c``: of its category, in ASCII or in its part of 128 code points."""
    if c in "0123456789":
        return "0123456789"
    if not c.isalnum() and c.isascii() and c.isprintable():
        return c if c in " \"'" else "!#$%&*+-./:;=?@^_~"
    start, kind = ord(c) & ~127, unicodedata.category(c)
    same = [x for x in map(chr, range(start, start + 128)) if unicodedata.category(x) == kind]
    # a character that is alone in its part is replaced by a letter
    return "".join(same) if len(same) > 1 else "abcdefghijklmnopqrstuvwxyz"


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def session_key(spark: SparkSession) -> bytes:
    """The key of the session's setting ``KEY_SETTING``, else a new random one: surrogates then differ from call to call."""
    text = spark.conf.get(KEY_SETTING, None)
    return text.encode() if text else secrets.token_bytes(32)


def _canonical(kind: str, made: str) -> str:
    return made.lower() if kind == "email" else made


def _class(kind: str) -> str:
    return kind.split("-")[0]


def entities(docs: DataFrame) -> DataFrame:
    """(kind, value, n): the different entities of ``docs(text)`` and how often they occur."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(k, v) for t in batch.column(0).to_pylist() for _, _, k, v in find(t)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.string())], ["kind", "value"])

    return docs.select("text").mapInArrow(run, "kind string, value string").groupBy("kind", "value").agg(F.count("*").alias("n"))


def redraws(found: DataFrame, key: bytes, tool_of=Surrogates) -> DataFrame:
    """(kind, value, draw) of the entities that need a further draw to keep all surrogates apart.

    A surrogate is lost if an entity of its class has that form, or if an entity that drew less often, or as
    often and has a smaller digest, has drawn the same. Only losers draw again, against all surrogates taken.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tool_of(key)
        for batch in batches:
            kinds, values, draws = (c.to_pylist() for c in batch.columns)
            made = [_canonical(k, tool.known(k, v, d)) for k, v, d in zip(kinds, values, draws, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], ["kind", "value", "draw", "made"])

    found = found.repartition(shuffle_parts(found.sparkSession, found.count(), DRAW_ROWS), "kind", "value")
    shape = "kind string, value string, draw int, made string"
    cls = F.split("kind", "-")[0]
    real = found.select(cls.alias("class"), F.col("value").alias("made")).distinct()
    taken = stage(found.select("kind", "value", F.lit(0).alias("draw")).mapInArrow(draw, shape).withColumn("class", cls), "drawn")
    for _ in range(MOST_ROUNDS):
        one = taken.groupBy("class", "made").agg(F.min(F.struct("draw", F.xxhash64("kind", "value").alias("h"), "kind", "value")).alias("first"), F.count("*").alias("n"))
        hit = one.join(real.withColumn("real", F.lit(True)), ["class", "made"], "left").filter("n > 1 or real")
        lost = taken.join(hit.select("class", "made", "first", "real"), ["class", "made"])
        lost = lost.filter(F.coalesce("real", F.lit(False)) | (F.col("first.kind") != F.col("kind")) | (F.col("first.value") != F.col("value")))
        lost = stage(lost.select("kind", "value", (F.col("draw") + 1).alias("draw")), "lost")
        if lost.isEmpty():
            return taken.filter("draw > 0").select("kind", "value", "draw")
        again = lost.mapInArrow(draw, shape).withColumn("class", cls)
        before, lost_before = taken, lost
        taken = stage(taken.join(lost.select("kind", "value"), ["kind", "value"], "left_anti").unionByName(again), "drawn")
        drop_stage(before)
        drop_stage(lost_before)
    raise RuntimeError(f"surrogates still meet after {MOST_ROUNDS} draws")


def pseudonymise(docs: DataFrame, key: bytes, most_sent: int = MOST_SENT, tool_of=Surrogates) -> DataFrame:
    """docs with the entities in ``text`` replaced, and ``n_entities``, their number.

    ``key`` is secret: with it, numbers can be turned back; with the same key, an entity has the same
    surrogate in other tables, but for those that draw again. Null texts stay null, texts without entities
    stay as they are, byte for byte. Rows, repeated ones too, are not merged or dropped, ids play no part. An
    empty table gives an empty result. A column of docs named ``n_entities`` is replaced; all others are kept.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop("n_entities")
    more = stage(redraws(stage(entities(docs), "entities"), key, tool_of), "redraws")
    at = docs.columns.index("text")
    names = [*docs.columns, "n_entities"]
    if more.limit(most_sent + 1).count() > most_sent:
        # too many for a broadcast: every row gets its own share of them by a join
        row, draws = free_name(docs, "row"), free_name(docs, "draws")
        docs = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
        own = _mentions(docs.select(F.col(row).alias("row"), "text")).join(more, ["kind", "value"])
        own = own.groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("kind", "value", "draw")).alias(draws))
        docs = docs.join(own, row, "left").drop(row)
        sent = None
    else:
        sent = spark.sparkContext.broadcast({(x.kind, x.value): x.draw for x in more.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tool_of(key)
        for batch in batches:
            own = None if sent else batch.column(batch.num_columns - 1).to_pylist()
            texts, counts = [], []
            for i, text in enumerate(batch.column(at).to_pylist()):
                found = find(text)
                counts.append(len(found))
                if found:
                    draws = sent.value if sent else {(x["kind"], x["value"]): x["draw"] for x in own[i] or ()}
                    parts, last = [], 0
                    for a, b, kind, value in found:
                        parts += [text[last:a], tool(kind, value, draws.get((kind, value), 0), text[a:b])]
                        last = b
                    text = "".join([*parts, text[last:]])
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[: len(names) - 1])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names)

    schema = StructType([*docs.schema.fields[: len(names) - 1], StructField("n_entities", LongType())])
    return docs.mapInArrow(run, schema)


def _mentions(rows: DataFrame) -> DataFrame:
    """(row, kind, value) of the entities of ``rows(row, text)``, each once a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(r, *x) for r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in sorted({f[2:] for f in find(t)})]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in got], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))], ["row", "kind", "value"])

    return rows.mapInArrow(run, "row long, kind string, value string")
