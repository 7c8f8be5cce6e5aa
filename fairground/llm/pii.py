"""Personal data: detection and keyed surrogates.

Each detected value gets a replacement of its own type: same script and letter case, same digits and separators, same
gender for names, a valid check digit where the original had one. The replacement is drawn from a keyed hash of the
value, so it is the same in every document; a check over all values of the corpus draws again where two would share one
or where one equals a value that occurs, so distinct values stay distinct.

A person's name is found behind a form of address, or as a known given name with a family name; the same names are then
replaced wherever they stand alone in that document, in capitals too. A name is letters of any cased script with a capital in
front, also with more capitals inside, apostrophes and hyphens ("McDonald", "O'Brien"); particles ("van der") stay. A given name has one gender in the whole corpus: the one most
forms of address give it, else the one it is known for.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairground.llm.common import Scratch, concat, free_name, slices, text_column

#: Values that were drawn again, up to this many, are broadcast; more are joined to their documents.
BROADCAST_VALUES = 100_000

#: Forms of address and the gender they tell.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "M": "m", "Señor": "m", "Sr": "m", "Don": "m", "Signor": "m", "Sig": "m", "господин": "m", "κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mademoiselle": "f", "Señora": "f", "Sra": "f", "Doña": "f", "Signora": "f", "госпожа": "f", "κυρία": "f",
    "Dr": "n", "Prof": "n",
}
#: Given names from which surrogates are drawn, by script and gender.
GIVEN = {
    ("latin", "m"): "Adam Bruno Carlo Daniel Emil Felix Georg Hugo Ivan Jonas Karl Leon Marco Nils Oscar Paul Quentin Robin Simon Tomas Ulrich Victor Walter Xavier Yann Zeno".split(),
    ("latin", "f"): "Anna Bianca Clara Diana Elena Flora Greta Hanna Irene Julia Karin Laura Maria Nora Olivia Petra Rosa Sara Tina Ursula Vera Wanda Xenia Yvonne Zoe Ines".split(),
    ("latin", "n"): "Alex Andrea Bo Charlie Dana Eli Francis Gale Jules Kim Lee Maxime Nikita Noel Robin Sam Sasha Toni".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Иван Кирилл Лев Макар Олег Павел Роман".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Ксения Лидия Мария Ольга Полина Раиса".split(),
    ("cyrillic", "n"): "Женя Саша Валя Слава".split(),
    ("greek", "m"): "Αλέξης Βασίλης Γιάννης Δημήτρης Κώστας Λευτέρης Μάρκος Νίκος Πέτρος Στέλιος".split(),
    ("greek", "f"): "Άννα Βασιλική Δέσποινα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νεφέλη Σοφία".split(),
    ("greek", "n"): "Άρτεμις Ίρις Λίνος Φοίβος".split(),
}
SYLLABLES = {"latin": "ba be bo da de do fa fe ga ge ha ho ka ke la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se so ta te ti to va ve vi wa za".split(), "cyrillic": "ба бо ва ве да до ка ко ла ле ма мо на но па по ра ро са со та то".split(), "greek": "βα βο γα γο δα δο κα κο λα λο μα μο να νο πα πο ρα ρο τα το".split()}

#: More given names that tell a person where a family name follows, with their gender; a user may pass others.
KNOWN_GIVEN = {
    **{n: g for (_, g), names in GIVEN.items() for n in names if len(n) > 3},
    **dict.fromkeys("Alan Albert Andrew Antonio Arthur Charles Christian David Edward Frank George Giovanni Giuseppe Hans Henry Jacques James Jean John Joseph José Juan Klaus Louis Luca Luigi Manuel Mark Martin Matthew Michael Miguel Otto Pablo Pedro Peter Philip Pierre Richard Robert Stefan Stephen Thomas William Wolfgang".split(), "m"),
    **dict.fromkeys("Alice Ana Barbara Carla Carmen Caroline Catherine Charlotte Christine Claire Dorothy Elisabeth Elizabeth Emily Emma Francesca Giulia Heidi Helen Ingrid Isabella Jane Jennifer Juliette Linda Lucia Margaret Maria Marie Martha Mary Monica Nancy Patricia Paula Rachel Ruth Sarah Silvia Sophie Susan Teresa Victoria".split(), "f"),
}

def _letters(*categories: str) -> str:
    """The Latin, Greek, Cyrillic and Armenian letters of some categories, for a class of characters."""
    return "".join(c for c in map(chr, (*range(0x41, 0x590), *range(0x1E00, 0x1F00))) if unicodedata.category(c) in categories)


_UPPER, _LOWER = _letters("Lu"), _letters("Ll", "Mn")
_PART = rf"(?:[{_UPPER}]['’])?(?:[{_UPPER}][{_LOWER}]+)+"
_CAPITALS = rf"[{_UPPER}]{{2,}}(?:['’-][{_UPPER}]{{2,}})*|[{_UPPER}]['’][{_UPPER}]{{2,}}"
_NAME = rf"{_PART}(?:-{_PART})*"
#: Particles of family names; they are not replaced.
_PARTICLES = r"(?:(?:van|von|zu|der|den|ten|ter|de|del|della|di|da|dos|du|la|le|el|al|bin|ibn)\s){0,3}"
#: Words that follow a given name where no person is meant.
_NO_FAMILY = r"(?!(?:North|South|East|West|Station|Street|Road|Avenue|Square|Park|Bridge|Airport|Hotel|Hospital|University|Church|City|County|Island|Falls|Lake|River|Day)\b)"
#: Forms of address that are also written small, and those that in capitals are nothing else.
_SMALL = [t.lower() for t in TITLES if len(t) > 5 and t.isalpha() and t.lower() != t and t != "Madam"]
_LOUD = [t.upper() for t in ("Mr", "Mrs", "Mister", "Herr", "Herrn", "Monsieur", "Señor", "Signor", "Miss", "Madam", "Frau", "Madame", "Señora", "Signora", "Dr", "Prof")]
_BY_TITLE = {form: gender for t, gender in TITLES.items() for form in (t, t.lower(), t.upper())}
_TITLE = "|".join(sorted([*TITLES, *_SMALL], key=len, reverse=True))
_LOUD_TITLE = "|".join(sorted(_LOUD, key=len, reverse=True))
_KNOWN = "|".join(sorted(KNOWN_GIVEN, key=len, reverse=True))
#: Words that make a run of digits a card number even where the check digit does not.
CARD_WORDS = re.compile(r"(?i)\b(?:card|carta|carte|karte|tarjeta|visa|mastercard|amex)\b\W{0,3}(?:(?:number|num|nr|no)\b\W{0,3})?$")
#: One alternative a type, the more certain first.
PATTERN = re.compile(
    "|".join(
        (
            r"(?P<email>[A-Za-z0-9][\w.+-]{0,63}@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24})",
            r"(?P<secret>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\bgh[pousr]_[A-Za-z0-9]{20,}\b|\bsk-[A-Za-z0-9]{20,}\b)",
            r"(?P<assigned>\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[\"']?\s?[=:]\s?[\"']?(?P<value>[\w+/.-]{6,}=*)[\"']?)",
            r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)",
            r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))",
            r"(?P<card>(?<![\d.-])\d{4}(?P<sep>[ -]?)\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}(?![\d-]))",
            r"(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))",
            r"(?P<phone>(?<![\w.+-])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,5}(?![\w-])|(?<![\w.+(-])\(\d{2,4}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w-])|(?<![\w.+-])(?=(?:\D?\d){9})\d{2,4}(?:[ .-]\d{2,4}){2,4}(?![\w-]))",
            rf"(?P<name>\b(?P<title>{_TITLE})\.?\s{_PARTICLES}(?P<first>{_NAME})(?![\w'’])(?:\s{_PARTICLES}(?P<last>{_NAME})(?![\w'’]))?)",
            rf"(?P<loud>\b(?P<loud_title>{_LOUD_TITLE})\.?\s(?P<loud_first>{_CAPITALS})(?!\w)(?:\s(?P<loud_last>{_CAPITALS})(?!\w))?)",
            rf"(?P<person>\b(?P<given>{_KNOWN})\s{_PARTICLES}{_NO_FAMILY}(?P<family>{_NAME})(?![\w'’]))",
        )
    )
)


def _re2_class(shorthand: str) -> str:
    """The characters of one of Python's classes as ranges for RE2, whose own \\d, \\s and \\b know ASCII only."""
    runs = re.findall(shorthand + "+", "".join(map(chr, range(0x110000))))
    return "[" + "".join(rf"\x{{{ord(r[0]):x}}}-\x{{{ord(r[-1]):x}}}" for r in runs) + "]"


_D, _S = _re2_class(r"\d"), _re2_class(r"\s")
_RE2_PARTICLES = _PARTICLES.replace(r"\s", _S)
#: A text without any of these holds no value: a cheap test before the pattern, true wherever PATTERN matches. RE2 syntax.
#: Before a title stands no ASCII word character; what else is no word boundary is left to the pattern.
HINT = rf"@|AKIA|ASIA|gh[pousr]_|sk-|password|passwd|pwd|secret|token|api[_-]?key|{_D}[ .()-]?{_D}[ .()-]?{_D}[ .()-]?{_D}|{_D}\.{_D}|[A-Z]{{2}}{_D}{_D}|(?:^|[^0-9A-Za-z_])(?:{_TITLE}|{_LOUD_TITLE})\.?{_S}{_RE2_PARTICLES}\p{{Lu}}|(?:^|[^0-9A-Za-z_])(?:{_KNOWN}){_S}{_RE2_PARTICLES}\p{{Lu}}"


class Draw:
    """A stream of keyed choices for one value and attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed, self.block, self.bits, self.width = f"{kind}\0{attempt}\0{value}".encode(), 0, 0, 1
        self.key = hashlib.blake2b(key).digest()

    def below(self, n: int) -> int:
        while self.width < n << 32:
            more = hashlib.blake2b(self.seed + b"\0%d" % self.block, key=self.key, digest_size=32).digest()
            self.bits, self.width, self.block = (self.bits << 256) | int.from_bytes(more, "big"), self.width << 256, self.block + 1
        self.bits, out = divmod(self.bits, n)
        self.width //= n
        return out

    def shaped(self, text: str) -> str:
        """Letters become letters of the same case and script, digits digits; the rest stays."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif "а" <= c.lower() <= "я":
                out.append(chr((ord("а") if c.islower() else ord("А")) + self.below(32)))
            elif c.isalpha():
                out.append(chr((ord("a") if c.islower() else ord("A")) + self.below(26)))
            else:
                out.append(c)
        return "".join(out)


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


#: Attempts after which every replacement gets longer, so that a free one is found even where a format has none left.
LONGER_AFTER = 12


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0, gender: str = "n") -> str:
    """The replacement of a value in its canonical form. Later attempts may be longer, so that a free one is found."""
    draw = Draw(key, kind, value, attempt)
    more, beyond = max(0, attempt - 2), max(0, attempt - LONGER_AFTER)
    digits = lambda n: "".join(str(draw.below(10)) for _ in range(n))
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        return draw.shaped(local + "x" * more) + "@" + ".".join([*(draw.shaped(x) for x in labels[:-1]), labels[-1]])
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4 + beyond))
    if kind == "card":
        body = value[0] + digits(len(value) - 1 + beyond)
        if luhn(value):
            body = next(x for x in (body[:-1] + str(d) for d in range(10)) if luhn(x))
        return body
    if kind == "iban":
        return value[:2] + draw.shaped(value[2:]) + digits(beyond)
    if kind in ("phone", "ssn"):
        kept = 2 if value[0] == "+" else 0  # the sign and the first digit of a country code
        return value[:kept] + "".join(str(draw.below(10)) if c.isdigit() else c for c in value[kept:]) + digits(beyond)
    if kind.startswith("given"):
        script = kind.split(":")[1]
        names = GIVEN[script, gender]
        name = names[draw.below(len(names))]
        return name + "".join(SYLLABLES[script][draw.below(len(SYLLABLES[script]))] for _ in range(min(attempt, 4) + beyond))
    if kind.startswith("family"):
        script = kind.split(":")[1]
        return "".join(SYLLABLES[script][draw.below(len(SYLLABLES[script]))] for _ in range(3 + more)).capitalize()
    for prefix in ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-"):
        if value.startswith(prefix):
            return prefix + draw.shaped(value[len(prefix) :] + "x" * beyond)
    if re.fullmatch(r"[0-9a-f]+", value):
        return "".join("0123456789abcdef"[draw.below(16)] for _ in value) + "0" * more
    return draw.shaped(value + "x" * more)


def _script(name: str) -> str:
    return "greek" if "Ͱ" <= name[0] <= "Ͽ" else "cyrillic" if "Ѐ" <= name[0] <= "ӿ" else "latin"


def _quiet(name: str) -> str:
    """A name in capitals as it is written otherwise, so that both are one value."""
    return name.title() if len(name) > 1 and name.isupper() else name


_PLAIN = ("email", "secret", "iban", "ssn", "card", "ip", "phone")


def units(match: re.Match) -> list[tuple[str, str, str, int, int]]:
    """The values of a match as ``(kind, canonical value, gender, start, end)``; a name is its given and family name apart.

    ``gender`` is what a form of address tells of a given name, else empty. A run of digits that fails its check digit
    is no card unless it is called one.
    """
    if match["assigned"]:
        return [("secret", match["value"], "", *match.span("value"))]
    if match["name"] or match["loud"]:
        title, first, last = ("title", "first", "last") if match["name"] else ("loud_title", "loud_first", "loud_last")
        gender, family = _BY_TITLE[match[title]].replace("n", ""), last if match[last] else first
        out = [(f"family:{_script(match[family])}", _quiet(match[family]), "", *match.span(family))]
        return [(f"given:{_script(match[first])}", _quiet(match[first]), gender, *match.span(first)), *out] if match[last] else out
    if match["person"]:
        return [(f"{k}:{_script(match[k])}", match[k], "", *match.span(k)) for k in ("given", "family")]
    kind = next(k for k in _PLAIN if match[k])
    raw = match[kind]
    canonical = {"email": raw.lower(), "iban": raw.replace(" ", ""), "card": re.sub(r"\D", "", raw), "phone": re.sub(r"[^\d+]", "", raw)}.get(kind, raw)
    if kind == "card" and not luhn(canonical) and not CARD_WORDS.search(match.string, max(0, match.start() - 40), match.start()):
        return []
    return [(kind, canonical, "", *match.span(kind))]


def entities(text: str) -> list[tuple[str, str, str, int, int]]:
    """All values of a text in order, as ``units`` gives them, with the later and earlier mentions of its names alone.

    A name that the text also writes as a word in lower case ("will") is not followed beyond its form of address.
    """
    found = [u for match in PATTERN.finditer(text) for u in units(match)]
    names: dict[str, str] = {}
    for kind, value, *_ in found:
        if kind.startswith(("given", "family")):
            names.setdefault(value, kind)
    names = {n: k for n, k in names.items() if not re.search(rf"(?<!\w){re.escape(n.lower())}(?!\w)", text)}
    if not names:
        return found
    forms = {form: n for n in sorted(names) for form in (n.upper(), n) if len(n) > 2 or form == n}
    alone = re.compile(rf"(?<![\w@.-])(?:{'|'.join(map(re.escape, sorted(forms, key=len, reverse=True)))})(?![\w@])")
    spans, at = [*((s, e) for *_, s, e in found), (len(text), len(text))], 0
    for start, end in spans:
        found += [(names[forms[m[0]]], forms[m[0]], "", *m.span()) for m in alone.finditer(text, at, start) if m.end() <= start]
        at = max(at, end)
    return sorted(found, key=lambda u: u[3])


def known_gender(kind: str, value: str) -> str:
    return KNOWN_GIVEN.get(value, "n") if kind.startswith("given") else "n"


def in_format(kind: str, replacement: str, raw: str) -> str:
    """The replacement with the separators and the letter case of the mention."""
    if kind in ("card", "phone", "iban"):
        chars = iter(replacement)
        out = [next(chars, "") if c.isalnum() or c == "+" else c for c in raw]
        return "".join(out) + "".join(chars)
    if kind == "email" and raw.isupper() or kind.startswith(("given", "family")) and len(raw) > 1 and raw.isupper():
        return replacement.upper()
    return replacement


def rewrite(text: str, key: bytes, settled: dict[tuple[str, str], tuple[int, str]]) -> tuple[str, list[str]]:
    """The text with every value replaced, and the kinds that were found; ``settled`` has the values that are not as by default."""
    out, at, kinds = [], 0, []
    for kind, value, _, start, end in entities(text):
        attempt, gender = settled.get((kind, value)) or (0, known_gender(kind, value))
        out += [text[at:start], in_format(kind, surrogate(key, kind, value, attempt, gender), text[start:end])]
        at = end
        kinds.append(kind.split(":")[0])
    return "".join([*out, text[at:]]), kinds


def _hinted(texts: pa.Array) -> np.ndarray:
    return np.flatnonzero(pc.match_substring_regex(texts, HINT).to_numpy(zero_copy_only=False).astype(bool))


def mentions(docs: DataFrame) -> DataFrame:
    """``text_key, kind, value, gender``: each value of a text once; the key is a checksum of the text."""

    def find(batches):
        for batch in slices(batches):
            texts, keys, rows = concat(batch.column("text")), batch.column("text_key"), []
            for i in _hinted(texts):
                rows += sorted({(int(i), *u[:3]) for u in entities(texts[i].as_py())})
            yield pa.RecordBatch.from_arrays([keys.take(pa.array([r[0] for r in rows], pa.int64())), *(pa.array([r[n] for r in rows], pa.string()) for n in (1, 2, 3))], ["text_key", "kind", "value", "gender"])

    return docs.select(text_column(docs)).select("text", F.md5("text").alias("text_key")).mapInArrow(find, "text_key string, kind string, value string, gender string")


def settle(spark: SparkSession, values: DataFrame, key: bytes, scratch: Scratch) -> DataFrame:
    """``kind, value, gender, attempt``: the first attempt of each value whose surrogate is its own and is no value that occurs.

    Of values that draw the same surrogate the smallest keeps it, the others draw again, until none is shared. Given
    and family names of a script are held apart from each other too, whatever their gender. Late attempts get longer,
    so the rounds end.
    """

    def draw(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "value", "attempt", "gender")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([surrogate(key, *r) for r in rows], pa.string())], [*names, "surrogate"])

    names = ["space", "kind", "value", "gender", "attempt"]
    drawn = lambda rows: rows.select(*names).mapInArrow(draw, "space string, kind string, value string, gender string, attempt int, surrogate string")
    space = F.regexp_replace("kind", "^(given|family):", "name:").alias("space")
    now, step = scratch.table("drawn-0", drawn(values.select(space, "kind", "value", "gender", F.lit(0).alias("attempt")))), 0
    real = values.select(space, F.col("value").alias("surrogate")).distinct()
    while True:
        # Who draws again keeps its place only against those who do so too: a settled value is never moved.
        owner = now.groupBy("space", "surrogate").agg(F.min(F.struct("attempt", "kind", "value")).alias("first"), F.count("*").alias("n")).where("n > 1").select("space", "surrogate", "first")
        shared = now.join(owner, ["space", "surrogate"]).where("kind <> first.kind or value <> first.value").select("kind", "value")
        lost = scratch.table(f"lost-{step}", shared.unionByName(now.join(real, ["space", "surrogate"], "left_semi").select("kind", "value")).distinct())
        if lost.isEmpty():
            return now.select("kind", "value", "gender", "attempt")
        step += 1
        again = drawn(now.join(lost, ["kind", "value"], "left_semi").withColumn("attempt", F.col("attempt") + 1))
        new = scratch.table(f"drawn-{step}", now.join(lost, ["kind", "value"], "left_anti").unionByName(again))
        scratch.drop(f"drawn-{step - 1}", f"lost-{step - 1}")
        now = new


def replace_personal_data(spark: SparkSession, docs: DataFrame, key: bytes) -> DataFrame:
    """The documents with surrogates in ``text``, and ``pii_kinds`` (array of the kinds found, one a mention).

    Other columns stay as they are, but for one of that name. Null text stays null with no kinds, empty text stays
    empty; long texts are read whole; repeated rows are rewritten alike, whatever their ids. Where matches could begin
    at one place the more certain type is taken. An empty table gives no rows.
    """
    scratch = Scratch(spark, "pii")
    found = scratch.table("mentions", mentions(docs))
    votes = lambda g: F.count_if(F.col("gender") == g)
    default = F.create_map(*(F.lit(x) for pair in KNOWN_GIVEN.items() for x in pair))
    usual = F.when(F.col("kind").startswith("given"), F.coalesce(F.try_element_at(default, F.col("value")), F.lit("n"))).otherwise("n")
    gender = F.when(F.col("m") > F.col("f"), "m").when(F.col("f") > F.col("m"), "f").otherwise(usual).alias("gender")
    counted = found.groupBy("kind", "value").agg(votes("m").alias("m"), votes("f").alias("f"))
    values = scratch.table("values", counted.select("kind", "value", gender))
    settled = scratch.table("settled", settle(spark, values, key, scratch).where((F.col("attempt") > 0) | (F.col("gender") != usual)))
    few = settled.count() <= BROADCAST_VALUES
    of, moved = free_name("_of", *docs.columns), free_name("_moved", *docs.columns)
    if few:
        held = spark.sparkContext.broadcast({(r["kind"], r["value"]): (r["attempt"], r["gender"]) for r in settled.collect()})
        rows = docs
    else:
        own = found.select("text_key", "kind", "value").distinct().join(settled, ["kind", "value"]).groupBy(F.col("text_key").alias(of)).agg(F.collect_list(F.struct("kind", "value", "attempt", "gender")).alias(moved))
        own = scratch.table("moved", own)
        # Wordless texts hold no mention, and a third of all rows may share one of them: they go past the join.
        text, held = F.coalesce(F.col("text").cast("string"), F.lit("")), None
        wordless = text.rlike(r"^\s*$")
        met = docs.where(~wordless).join(own, F.md5(text) == own[of], "left").drop(of)
        rows = met.unionByName(docs.where(wordless).withColumn(moved, F.lit(None).cast(own.schema[moved].dataType)))
    names = [c for c in docs.columns if c != "pii_kinds"]

    def replace(batches):
        for batch in slices(batches):
            texts = concat(batch.column("text")).cast(pa.string())
            kinds: list[list[str]] = [[] for _ in range(len(texts))]
            changed, new = np.zeros(len(texts), bool), []
            for i in _hinted(pc.fill_null(texts, "")):
                own = held.value if few else {(m["kind"], m["value"]): (m["attempt"], m["gender"]) for m in batch.column(moved)[int(i)].as_py() or ()}
                text, kinds[i] = rewrite(texts[int(i)].as_py(), key, own)
                if kinds[i]:
                    changed[i] = True
                    new.append(text)
            texts = pc.replace_with_mask(texts, pa.array(changed), pa.array(new, pa.string()))
            columns = [texts if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kinds, pa.list_(pa.string()))], [*names, "pii_kinds"])

    schema = ", ".join(f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema if f.name in names)
    return rows.mapInArrow(replace, f"{schema}, pii_kinds array<string>")
