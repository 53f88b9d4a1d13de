"""Surrogates for personal data: every entity gets a keyed replacement of its own type, gender, script and format.

An entity is a kind and a normal form (digits of phone and card numbers, lower case of the others), so that one entity
written in two ways keeps one surrogate in every document. The entities of a kind are numbered in the order of a keyed
hash, and a keyed permutation gives each number a code of its own that no real entity of the corpus carries. The code
stands at a fixed place of the surrogate, so surrogates are distinct by construction; a keyed hash fills the rest.

Found are mail addresses, phone numbers with a country code or in the three-three-four form, IPv4 addresses, card numbers
of 16 digits and of 15 that begin with 34 or 37, and names after a title. Not found are names without a title, IPv6
addresses, IBANs and national identity numbers. "Mr. John Smith" and "Mr. Smith" are two entities.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textops import document_keys, free_names, sized, stored

#: Rows that the joins of entities and texts may broadcast.
BROADCAST_ROWS = 200_000

# The kinds, what they look like, and titles that tell a gender.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_MALE = "Mr\\.|Herr|Monsieur|Señor"
_FEMALE = "Mrs\\.|Ms\\.|Frau|Madame|Señora"
_WORD = "\\p{Lu}(?:['’]\\p{Lu})?\\p{Ll}{1,30}(?:[-'’]?\\p{Lu}\\p{Ll}{1,30}){0,3}"
PATTERNS = (
    ("email", "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\\.[A-Za-z0-9-]{1,63}){0,8}\\.[A-Za-z]{2,24}"),
    ("phone", "(?<![0-9A-Za-z+])(?:\\+[0-9]{1,3}(?:[ .-]?(?:\\([0-9]{2,4}\\)|[0-9]{2,4})){2,5}|\\([0-9]{3}\\) ?[0-9]{3}-[0-9]{4}|(?<![-.])[0-9]{3}-[0-9]{3}-[0-9]{4}(?!-))(?![0-9])"),
    ("ip", f"(?<![0-9A-Za-z.]){_OCTET}(?:\\.{_OCTET}){{3}}(?!\\.?[0-9A-Za-z])"),
    ("card", "(?<![0-9A-Za-z])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9A-Za-z])"),
    ("name", f"(?<![\\p{{L}}])(?:{_FEMALE}|{_MALE}) {_WORD}(?: {_WORD})?"),
)
_GIVEN = {
    ("male", "latin"): "Adam Bruno Carl David Emil Felix Georg Henri Ivan Jonas Karl Leon Marco Niels Oscar Pablo",
    ("female", "latin"): "Anna Berta Clara Diana Elena Flora Greta Helena Irma Julia Karin Laura Maria Nina Olga Paula",
    ("male", "cyrillic"): "Антон Борис Вадим Глеб Денис Егор Захар Иван Кирилл Лев Марк Никита Олег Павел Роман Семён",
    ("male", "greek"): "Άγγελος Γιώργος Δημήτρης Ηλίας Θωμάς Ιάσων Κώστας Λουκάς Μάρκος Νίκος Ορέστης Πέτρος Σπύρος Τάσος Φίλιππος Χρήστος",
    ("female", "greek"): "Άννα Βάσω Γεωργία Δάφνη Ελένη Ζωή Ηρώ Θάλεια Ιωάννα Κατερίνα Λένα Μαρία Νίκη Ξένια Όλγα Σοφία",
    ("female", "cyrillic"): "Анна Белла Вера Галина Дарья Ева Зоя Инна Клара Лидия Мария Нина Ольга Полина Раиса Софья",
}
_SYLLABLES = {
    "latin": "ba den el for gar hol in kel lan mor nes or pel ran sel tor",
    "cyrillic": "ба ве го де жо зи ка ле мо не по ра со ту фе ха",
    "greek": "βα γε δι ζο θε κα λι μο νε πα ρι σο τα φι χε ψα",
}
_SCRIPTS = (("cyrillic", "[\\u0400-\\u04FF]"), ("greek", "[\\u0370-\\u03FF]"))
#: Letters that stand for the digits of a code in addresses.
_CODE_LETTERS = "bdfghklmnp"
_MARK, _ESCAPE = "\x01", "\x02"


def escaped(text: Column) -> Column:
    """The text without marks; unescaped() gives the text back."""
    safe = F.replace(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "\x04")), F.lit(_MARK), F.lit(_ESCAPE + "\x03"))
    return F.when(text.rlike(f"[{_MARK}{_ESCAPE}]"), safe).otherwise(text)


def unescaped(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit(_ESCAPE + "\x03"), F.lit(_MARK)), F.lit(_ESCAPE + "\x04"), F.lit(_ESCAPE))
    return F.when(F.contains(text, F.lit(_ESCAPE)), plain).otherwise(text)


def pieces_of(text: Column) -> Column:
    """The text cut so that every second piece is an entity."""
    every = "|".join(pattern for _, pattern in PATTERNS)
    return F.split(F.regexp_replace(escaped(F.coalesce(text, F.lit(""))), f"(?:{every})", f"{_MARK}$0{_MARK}"), _MARK)


def kind_of(value: Column) -> Column:
    return (
        F.when(F.contains(value, F.lit("@")), "email")
        .when(value.rlike(f"^(?:{_FEMALE}|{_MALE}) "), "name")
        .when(value.rlike("^[+(]|^[0-9]{3}-[0-9]{3}-"), "phone")
        .when(value.rlike("^[0-9]+[.]"), "ip")
        .otherwise("card")
    )


def normal_form(kind: Column, value: Column) -> Column:
    return F.when(kind.isin("phone", "card"), F.regexp_replace(value, "[^0-9]", "")).otherwise(F.lower(value))


def _digits(stream: Column) -> Column:
    return F.translate(stream, "abcdef", "012345")


def _pick(words: str, stream: Column, at: int) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words.split()]), F.conv(F.substring(stream, at, 1), 16, 10).cast("int"))


def luhn_sum(digits: Column) -> Column:
    """The checksum of a card number: 0 modulo 10 where it is valid."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


class Codes:
    """The codes of one kind for a number of entities: how many signs a code has, and a keyed permutation.

    There are at least twice as many codes as entities, as those that real entities carry are left out.
    """

    def __init__(self, kind: str, entities: int, key: str):
        self.kind, self.entities, self.width = kind, entities, 1
        base = {"name": 16, "ip": 256}.get(kind, 10)
        if kind == "ip":
            self.width = 3
        while base**self.width < 2 * entities:
            self.width += 1
        if base**self.width > 10**18 or kind == "ip" and self.width > 4:
            raise ValueError(f"{entities} entities of kind {kind} have no surrogates of their own")
        self.count = base**self.width
        drawn = hashlib.sha256(f"{key}\x1f{kind}".encode()).digest()
        self.factor = max(1, int.from_bytes(drawn[:16], "big") % self.count)
        while gcd(self.factor, self.count) > 1:
            self.factor += 1
        self.shift = int.from_bytes(drawn[16:], "big") % self.count

    def permuted(self, number: Column) -> Column:
        wide = number.cast("decimal(18,0)") * F.lit(self.factor).cast("decimal(18,0)") + F.lit(self.shift).cast("decimal(18,0)")
        return (wide % F.lit(self.count).cast("decimal(19,0)")).cast("long")

    def carried(self, norm: Column) -> Column:
        """The code that a real entity of the kind carries where surrogates have theirs; null if it carries none."""
        if self.kind == "name":
            last, out = F.substring_index(norm, " ", -1), F.lit(None).cast("string")
            for words in _SYLLABLES.values():
                parts = F.regexp_extract_all(last, F.lit(f"({'|'.join(words.split())})"), F.lit(1))
                listed = F.array(*[F.lit(w) for w in words.split()])
                digits = F.transform(parts, lambda p: F.hex(F.array_position(listed, p) - 1))  # noqa: B023 (called at once)
                whole = (F.array_join(parts, "") == last) & (F.size(parts) == self.width)
                out = F.when(whole, F.array_join(digits, "")).otherwise(out)
            return F.conv(out, 16, 10).cast("long")
        if self.kind == "ip":
            octets = F.split(norm, "[.]")
            value = reduce(lambda a, b: a * 256 + b, [F.get(octets, F.lit(k)).cast("long") for k in range(4 - self.width, 4)])
            return F.when(F.lit(self.width == 4) | (F.get(octets, F.lit(0)) == "10"), value)
        signs = norm
        if self.kind == "email":
            signs = F.translate(F.regexp_replace(_before_top(norm), "[^a-z0-9]", ""), _CODE_LETTERS, "0123456789")
        elif self.kind == "card":
            signs = F.substr(norm, F.lit(1), F.length(norm) - 1)
        end = F.substr(signs, F.greatest(F.length(signs) - self.width + 1, F.lit(1)), F.lit(self.width))
        return F.when(end.rlike(f"^[0-9]{{{self.width}}}$"), end.cast("long"))

    def surrogate(self, norm: Column, code: Column, key: str) -> Column:
        """A normal form of the kind that carries the code."""
        stream = F.concat(*[F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(self.kind), F.lit(str(k)), norm), 256) for k in range(4)])
        signs = F.lpad(code.cast("string"), self.width, "0")
        if self.kind == "email":
            return F.concat(self._address(_before_top(norm), stream, signs), F.substring_index(norm, ".", -1))
        if self.kind == "phone":
            return F.concat(F.substring(norm, 1, 1), self._filled(F.length(norm) - 1, stream), signs)
        if self.kind == "card":
            front = F.concat(F.substring(norm, 1, 1), self._filled(F.length(norm) - 2, stream), signs)
            right = F.pmod(-luhn_sum(F.concat(front, F.lit("0"))), F.lit(10))
            wrong = (right + 1 + F.conv(F.substring(stream, 256, 1), 16, 10).cast("int") % 9) % 10
            return F.concat(front, F.when(luhn_sum(norm) % 10 == 0, right).otherwise(wrong).cast("string"))
        if self.kind == "ip":
            octets = [F.shiftright(code, 8 * k).bitwiseAND(255).cast("string") for k in reversed(range(self.width))]
            return F.concat_ws(".", *([F.lit("10")] if self.width == 3 else []), *octets)
        return self._name(norm, code, stream)

    def _filled(self, places: Column, stream: Column) -> Column:
        """Digits for the places that the code leaves; none if it takes them all."""
        return F.substr(_digits(stream), F.lit(1), F.greatest(places - self.width, F.lit(0)))

    def _address(self, front: Column, stream: Column, signs: Column) -> Column:
        missing = F.greatest(self.width - F.length(F.regexp_replace(front, "[^a-z0-9]", "")), F.lit(0))
        padded = F.concat(F.repeat(F.lit("b"), missing), front)
        carrier = F.regexp_extract(padded, f"(?:[a-z0-9][^a-z0-9]*+){{{self.width}}}$", 0)
        free = F.substr(padded, F.lit(1), F.length(padded) - F.length(carrier))
        shaped = F.transform(
            F.split(free, ""),
            lambda c, i: F.when(c.rlike("[0-9]"), F.substr(_digits(stream), i % 256 + 1, F.lit(1)))
            .when(c.rlike("[a-z]"), F.translate(F.substr(stream, i % 256 + 1, F.lit(1)), "0123456789abcdef", "abcdefghiklmnopr"))
            .otherwise(c),
        )
        state = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

        def step(acc: Column, c: Column) -> Column:
            digit = F.substr(signs, acc["at"], F.lit(1))
            new = F.when(c.rlike("[0-9]"), digit).when(c.rlike("[a-z]"), F.translate(digit, "0123456789", _CODE_LETTERS)).otherwise(c)
            return F.struct((acc["at"] + c.rlike("[a-z0-9]").cast("int")).alias("at"), F.concat(acc["out"], new).alias("out"))

        return F.concat(F.array_join(shaped, ""), F.aggregate(F.split(carrier, ""), state, step, lambda acc: acc["out"]))

    def _name(self, norm: Column, code: Column, stream: Column) -> Column:
        title = F.substring_index(norm, " ", 1)
        female = title.rlike(f"^(?i:{_FEMALE})$")
        signs = F.lpad(F.conv(code.cast("string"), 10, 16), self.width, "0")

        def named(gender: str, script: str) -> Column:
            last = F.concat(*[_pick(_SYLLABLES[script], signs, k + 1) for k in range(self.width)])
            first = F.concat(_pick(_GIVEN[gender, script], stream, 1), F.lit(" "))
            return F.concat(title, F.lit(" "), F.when(F.size(F.split(norm, " ")) > 2, first).otherwise(""), last)

        def scripted(gender: str) -> Column:
            out = named(gender, "latin")
            for script, signs_of in _SCRIPTS:
                out = F.when(F.substring_index(norm, " ", -1).rlike(signs_of), named(gender, script)).otherwise(out)
            return out

        return F.lower(F.when(female, scripted("female")).otherwise(scripted("male")))


def _before_top(address: Column) -> Column:
    return F.substr(address, F.lit(1), F.length(address) - F.length(F.substring_index(address, ".", -1)))


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows with a number from 0 in each kind, by a range sort over all tasks and one count a task and kind."""
    at = F.monotonically_increasing_id()
    placed = stored(rows.orderBy("kind", *order).withColumn("at", at), "placed").withColumn("task", F.shiftright("at", 33))
    counts = placed.groupBy("kind", "task").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = F.sum("rows").over(Window.partitionBy("kind").orderBy("task")) - F.col("rows")
    starts = counts.select("kind", "task", (before - F.col("first")).alias("start"))
    return placed.join(F.broadcast(starts), ["kind", "task"]).withColumn("number", F.col("at") + F.col("start")).drop("at", "task", "start")


def rewritten(kind: Column, value: Column, form: Column) -> Column:
    """A surrogate's normal form in the writing of a value: its separators, its title, its capitals."""
    state = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    digits = F.aggregate(
        F.split(value, ""),
        state,
        lambda acc, c: F.when(
            c.rlike("[0-9]"),
            F.struct((acc["at"] + 1).alias("at"), F.concat(acc["out"], F.substr(form, acc["at"], F.lit(1))).alias("out")),
        ).otherwise(F.struct(acc["at"].alias("at"), F.concat(acc["out"], c).alias("out"))),
        lambda acc: acc["out"],
    )
    longer = F.substr(form, F.length(F.regexp_replace(value, "[^0-9]", "")) + 1, F.length(form))
    digits = F.concat(digits, longer)
    name = F.concat(F.substring_index(value, " ", 1), F.lit(" "), F.initcap(F.regexp_replace(form, "^[^ ]* ", "")))
    return F.when(kind.isin("phone", "card"), digits).when(kind == "name", name).otherwise(form)


def draw_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, form): a surrogate for each distinct (kind, norm); no two alike, none a real entity of the kind.

    An address keeps its top domain and its pattern of letters, digits and signs, a phone number its length and first
    digit, a card also whether its checksum holds, a name its title, gender, script (Latin, Cyrillic or Greek; others
    become Latin) and number of words. Where a kind has more entities than a form has places for their codes, the form is
    made longer: letters in front of an address, digits at the end of a number. IPv4 addresses go to 10.0.0.0/8, beyond
    8,388,608 of them to the whole space; beyond 2,147,483,648 there is an error. No entities give no rows.
    """
    known = stored(entities.select("kind", "norm").distinct(), "entities")
    kinds = [Codes(r["kind"], r["count"], key) for r in known.groupBy("kind").count().collect()]
    if not kinds:
        return known.withColumn("form", F.col("norm"))

    def each(column) -> Column:
        return reduce(lambda rest, codes: F.when(F.col("kind") == codes.kind, column(codes)).otherwise(rest), kinds, F.lit(None))

    spark = known.sparkSession
    drawn = [
        spark.range(2 * c.entities).select(F.lit(c.kind).alias("kind"), "id", c.permuted(F.col("id")).alias("code")) for c in kinds
    ]
    taken = known.select("kind", each(lambda c: c.carried(F.col("norm"))).alias("code")).where("code IS NOT NULL").distinct()
    free = reduce(DataFrame.unionByName, drawn).join(taken, ["kind", "code"], "left_anti")
    ranked = numbered(known, F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "norm"), 256), F.col("norm"))
    paired = ranked.join(numbered(free, F.col("id")).select("kind", "number", "code"), ["kind", "number"])
    return paired.select("kind", "norm", each(lambda c: c.surrogate(F.col("norm"), F.col("code"), key)).alias("form"))


def with_surrogates(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", found_col: str = "found") -> DataFrame:
    """The documents with every entity replaced, and a column found_col: the kinds of its entities, in their order.

    Texts without entities stay as they are, nulls stay null, whole texts are read however long. Rows repeated get the
    same text. Entities are ordered by a keyed hash, ties by the entity, so a run gives the same surrogates for the same
    corpus and key. Other columns stay; found_col takes a free name if the documents have one of that name.
    """
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    keys = document_keys(text, doc_id)
    cut = docs.select(keys[0].alias("k1"), keys[1].alias("k2"), pieces_of(text).alias("p"))
    spread = cut.select("k1", "k2", F.posexplode("p").alias("at", "value")).where("at % 2 = 1")
    kind = kind_of(F.col("value"))
    each = spread.distinct().withColumn("kind", kind).withColumn("norm", normal_form(F.col("kind"), F.col("value")))
    each = stored(each, "entities")
    forms = sized(stored(draw_surrogates(each, key), "forms"), BROADCAST_ROWS)
    told = each.join(forms, ["kind", "norm"]).withColumn("new", rewritten(F.col("kind"), F.col("value"), F.col("form")))
    k1, k2, news, found, out = free_names(docs, "k1", "k2", "news", found_col, "new_text")
    lists = told.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("at", "kind", "new"))).alias(news))
    lists = lists.withColumnsRenamed({"k1": k1, "k2": k2})
    joined = docs.join(sized(stored(lists, "lists"), BROADCAST_ROWS), (keys[0] == F.col(k1)) & (keys[1] == F.col(k2)), "left")
    whole = F.array_join(
        F.transform(
            pieces_of(text),
            lambda p, i: F.when(i % 2 == 1, F.get(F.col(news), ((i - 1) / 2).cast("int"))["new"]).otherwise(p),
        ),
        "",
    )
    joined = joined.withColumn(out, F.when(F.col(news).isNull(), text).otherwise(unescaped(whole)))
    kinds = F.coalesce(F.transform(news, lambda x: x["kind"]), F.array().cast("array<string>"))
    columns = [F.col(out).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, kinds.alias(found))
