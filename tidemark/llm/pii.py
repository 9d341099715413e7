"""Surrogates for personal data, in DataFrame functions only.

One pattern finds the mentions; each gets a type and a canonical value (an e-mail address in lower case, the digits of
a telephone number), so all mentions of one entity share a surrogate, in every document.  A surrogate is made from
sha-256 of a secret key, the type, the canonical value and an attempt number.  It keeps the type and the format: the
script, case and length of letters, digits as digits, valid octets, check digits of cards and accounts, a title's gender
in a name.  A name is the same person in capitals or not, and in a text that has it behind a title also without one, as a
family name alone, and behind a title without a gender.

The distinct entities form a table.  Surrogates of attempt 0 that equal each other, or a value that occurs in the
corpus, are found by grouping and joining; all but one of them go to the next attempt, until none is left.  So
different entities keep different surrogates and no surrogate is someone's real value.  Family names are assigned
first, each once for its gender, so all mentions of a family share one; given names follow.  Both get a syllable more
with every attempt, so free names do not run out.  The surrogates are joined back
to the mentions, and only texts with mentions are put together again; the others pass as they are.

Defined cases: null and empty texts stay as they are; repeated rows are rewritten alike; mentions that overlap are
taken from the left, the longer type first in ``TYPES``; an empty table gives an empty result; all columns pass.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import all_columns, col, written

_PART = r"\p{Lu}\p{L}+(?:[-']\p{Lu}\p{L}+)?"
# all capitalised parts that follow, initials before a part and particles between two
_NAME = rf"(?:\p{{Lu}}\. )*+{_PART}(?: (?:\p{{Lu}}\. )*+(?:(?:de|del|della|der|den|di|da|dos|du|la|van|von|zu) )*+{_PART})*+"
# fixed values: titles by gender
MALE = r"(?:M[Rr]\.?|Mister|Herr|HERR|Monsieur|Señor|Sr\.|г-н|господин|κ\.|Κύριος)"
FEMALE = r"(?:M[Rr][Ss]\.?|M[Ss]\.?|Miss|Frau|FRAU|Madame|Mme|Señora|Sra\.|г-жа|госпожа|κα\.|Κυρία)"
NEUTRAL = r"(?:D[Rr]\.?|Prof\.?|PROF\.?|Doctor|Professor|[Дд]октор|[Пп]рофессор|Δρ\.?|Καθηγητής)"
TITLES = {"man": rf"{MALE} (?:{NEUTRAL} ){{0,4}}+", "woman": rf"{FEMALE} (?:{NEUTRAL} ){{0,4}}+", "person": rf"(?:{NEUTRAL} ){{1,4}}+"}
_TITLED = rf"^(?:{TITLES['man']}|{TITLES['woman']}|{TITLES['person']})"
NAMED = tuple(TITLES)
# every type starts where no letter or digit stands before; what stands after is checked by each
TYPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.){1,127}[A-Za-z]{2,}",
    **{kind: title + _NAME for kind, title in TITLES.items()},
    "key": r"AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"(?i:password|passwd|secret|token|api_key)\s?[=:]\s?\"?[A-Za-z0-9_/+.-]{8,}\"?",
    "hex": r"[0-9a-f]{32,64}(?![A-Za-z0-9])",
    "iban": r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?=(?: ?[A-Z]{0,4} ?\d){8}) [A-Z0-9]{4}(?: [A-Z0-9]{4}){1,6}(?: (?=[A-Z]{0,2}\d)[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "phone": r"(?<!\d\.)(?:(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?:\+\d{1,3}[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)|\+\d{8,14}(?!\d)|\+\d{1,3}[ .-](?:\(\d{1,5}\)|\d{1,5})(?:[ .-]?\d{2,8}){1,3}(?!\d))",
    "ssn": r"(?<!\d-)\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<!\d\.)(?:(?:\d{4}[ -]){3}\d{1,7}(?!\d)|\d{4}[ -]\d{6}[ -]\d{4,5}(?!\d)|\d{13,19}(?!\d))",
    "ipv6": r"(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f]{1,4}:[0-9A-Fa-f:]{4,37}(?![0-9A-Za-z:]))(?=[0-9A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "ip": r"(?<!\d\.)(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
}
PATTERN = r"(?<![\p{L}\p{N}])(?:" + "|".join(TYPES.values()) + ")"
# one of these is in every text that has a mention; a text without them need not be searched further
HINT = rf"[0-9@=:]|AKIA|[a-f]{{32}}|(?<!\p{{L}})(?:{MALE}|{FEMALE}|{NEUTRAL}) "
DIGITS = ("phone", "ssn", "card")
# fixed values: given names by script and gender, and what family names are composed of
GIVEN = {
    ("latin", "man"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Marco", "Nils", "Oscar", "Paul"),
    ("latin", "woman"): ("Alma", "Bella", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Ida", "Julia", "Karin", "Laura", "Maria", "Nora", "Olga", "Paula"),
    ("cyrillic", "man"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Олег"),
    ("cyrillic", "woman"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Инна", "Мария", "Ольга"),
    ("greek", "man"): ("Αλέξης", "Γιώργος", "Δημήτρης", "Κώστας", "Λουκάς", "Μάριος", "Νίκος", "Πέτρος"),
    ("greek", "woman"): ("Άννα", "Ελένη", "Ζωή", "Ειρήνη", "Κατερίνα", "Μαρία", "Νίκη", "Σοφία"),
}
GIVEN.update({(script, "person"): GIVEN[(script, "man")] + GIVEN[(script, "woman")] for script in ("latin", "cyrillic", "greek")})
SYLLABLES = {
    "latin": ("ba", "ber", "do", "del", "fa", "gar", "ko", "lin", "ma", "mor", "ne", "per", "ra", "san", "ti", "vel"),
    "cyrillic": ("ба", "вер", "го", "дин", "ка", "лов", "ма", "ров"),
    "greek": ("βα", "γε", "δι", "κο", "λα", "μη", "νο", "πα"),
}
ENDINGS = {("latin", "man"): "er", ("latin", "woman"): "er", ("cyrillic", "man"): "ов", ("cyrillic", "woman"): "ова", ("greek", "man"): "ης", ("greek", "woman"): "η"}
ENDINGS.update({(script, "person"): ENDINGS[(script, "man")] for script in ("latin", "cyrillic", "greek")})


def pattern_of(text: Column) -> Column:
    """The pattern of a text's mentions: ``PATTERN``, and the names that the text has behind a title, as written, in
    capitals and with small letters."""
    forms = F.flatten(F.transform(names_of(text), lambda x: F.array(x["name"], F.upper(x["name"]), F.initcap(F.lower(x["name"])))))
    longest = F.array_sort(F.array_distinct(forms), lambda a, b: F.length(b) - F.length(a))
    again = F.array_join(F.transform(longest, lambda x: F.concat(F.lit(r"\Q"), x, F.lit(r"\E"))), "|")
    return F.when(F.size(longest) == 0, F.lit(PATTERN)).otherwise(F.concat(F.lit(PATTERN[:-1] + r"|(?=\p{Lu})(?:"), again, F.lit(r")(?![\p{L}\p{N}]))")))


def names_of(text: Column) -> Column:
    """The (name, kind) of all names that stand behind a title, and of the family names of those of several parts.

    A name that stands behind titles with and without a gender has the gender's first.
    """
    def one(kind):
        found = F.regexp_extract_all(text, F.lit(rf"(?<![\p{{L}}\p{{N}}]){TITLES[kind]}({_NAME})"), F.lit(1))
        return F.transform(found, lambda n: F.struct(n.alias("name"), F.lit(kind).alias("kind")))

    full = F.concat(*[one(kind) for kind in NAMED])
    family = lambda names: F.transform(F.filter(names, lambda x: x["name"].contains(" ")), lambda x: F.struct(F.element_at(F.split(x["name"], " "), -1).alias("name"), x["kind"].alias("kind")))
    both = F.get(F.transform(F.array(full), lambda names: F.array_distinct(F.concat(names, family(names)))), F.lit(0))
    return F.when(text.rlike(rf"(?:{MALE}|{FEMALE}|{NEUTRAL}) "), both).otherwise(F.array().cast("array<struct<name:string,kind:string>>"))


def bare(mention: Column) -> Column:
    """A name without its titles."""
    return F.regexp_replace(mention, _TITLED, "")


def kind_of(mention: Column, names: Column) -> Column:
    """The type of a mention; of a name without a gendered title that of the same name in the text's ``names``."""
    known = F.get(F.filter(names, lambda x: F.lower(x["name"]) == F.lower(bare(mention))), F.lit(0))["kind"]
    return F.when(mention.rlike(rf"^(?:{MALE}|{FEMALE}) "), type_of(mention)).otherwise(F.coalesce(known, type_of(mention)))


def mentions(text: Column) -> Column:
    """All mentions of a text, from the left; a name that is behind a title once is found again without one."""
    return F.regexp_extract_all(text, F.concat(F.lit("("), pattern_of(text), F.lit(")")), F.lit(1))


def type_of(mention: Column) -> Column:
    """The type whose pattern the whole mention fits, the first of ``TYPES``."""
    out = F.lit("ip")
    for name, pattern in reversed(TYPES.items()):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def canonical(kind: Column, mention: Column) -> Column:
    """What mentions of one entity have in common."""
    digits = F.regexp_replace(mention, r"\D", "")
    name = F.initcap(F.lower(bare(mention)))
    return (F.when(kind == "phone", F.when(mention.startswith("+") & ~mention.rlike(r"\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}$"), digits).otherwise(F.substring(digits, -10, 10)))
            .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
            .when(kind.isin(*DIGITS), digits).when(kind.isin("email", "ipv6"), F.lower(mention)).when(kind.isin(*NAMED), name)
            .when(kind == "secret", F.regexp_extract(mention, r"[=:]\s?\"?([^\"]+)\"?$", 1)).otherwise(mention))


def _number(key: str, *parts: Column) -> Column:
    """A number from 0 to 2^48 - 1 that depends on the key and the parts."""
    text = F.concat_ws("\x1f", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def _alike(key: str, value: Column, *parts: Column, lower: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """The value with every letter and digit replaced by one of its kind; other characters stay."""
    kinds = (("0", "9", "0123456789"), ("a", "z", lower), ("A", "Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))

    def one(c, i):
        n = _number(key, *parts, i)
        out = c
        for low, high, chars in kinds:
            out = F.when(c.between(low, high), F.substring(F.lit(chars), (n % len(chars) + 1).cast("int"), F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _check_digit(digits: Column) -> Column:
    """The digits with the last one set so that the card number's check sum holds."""
    body = F.split(F.reverse(F.expr("substring(_d_, 1, length(_d_) - 1)")), "")
    doubled = F.transform(body, lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: (a + x).cast("int"))
    return F.concat(F.expr("substring(_d_, 1, length(_d_) - 1)"), F.pmod(10 - total % 10, F.lit(10)).cast("string"))


def _iban(country: Column, body: Column) -> Column:
    """The account with the check digits that make the whole number leave 1 when divided by 97."""
    rest = F.aggregate(F.split(F.concat(body, country, F.lit("00")), ""), F.lit(0), lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97).cast("int"))
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), body)


def _pick(values: tuple, n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def _by_script(name: Column, of) -> Column:
    """``of`` the script that the name has letters of."""
    return F.when(name.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(name.rlike(r"\p{IsGreek}"), of("greek")).otherwise(of("latin"))


def _syllables(key: str, script: str, count: Column, *parts: Column) -> Column:
    """``count`` syllables that depend on the key and the parts."""
    some = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda j: _pick(SYLLABLES[script], _number(key, *parts, j)))
    return F.when(count > 0, F.array_join(some, "")).otherwise("")


def _family(key: str, gender: str, name: Column, attempt: Column) -> Column:
    """A family name of 5 syllables and one more for each attempt, in the name's script."""
    of = lambda script: F.concat(F.initcap(_syllables(key, script, attempt + 5, F.lit("family"), name, attempt)), F.lit(ENDINGS[(script, gender)]))
    return _by_script(name, of)


def _given(key: str, gender: str, names: Column, attempt: Column) -> Column:
    """As many given names of the gender as ``names`` has, each with one syllable more for each attempt."""
    def one(name, i):
        of = lambda script: F.concat(_pick(GIVEN[(script, gender)], _number(key, F.lit("given"), name, i, attempt)),
                                     _syllables(key, script, attempt, F.lit("more"), name, i, attempt))
        return _by_script(name, of)

    return F.array_join(F.transform(F.split(names, " "), one), " ")


def with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, canon, attempt) with the surrogate of that attempt; names bring their family's surrogate (family)."""
    kind, canon, attempt = F.col("kind"), F.col("canon"), F.col("attempt")
    alike = _alike(key, canon, kind, canon, attempt)
    octet = lambda j: (_number(key, kind, canon, attempt, F.lit(j)) % 254 + 1).cast("string")
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    tail = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(tail))
    more = _syllables(key, "latin", F.greatest(attempt - 4, F.lit(0)), kind, canon, attempt)        # short addresses do not run out
    email = F.concat(_alike(key, local, kind, canon, attempt), more, F.lit("@"), _alike(key, host, kind, domain, F.lit("domain"), attempt), tail)
    out = F.when(kind == "ip", F.concat_ws(".", *[octet(j) for j in range(4)])).when(kind == "email", email)
    out = out.when(kind == "key", F.concat(F.lit("AKIA"), _alike(key, F.expr("substring(canon, 5)"), kind, canon, attempt)))
    out = out.when(kind == "iban", _iban(F.substring("canon", 1, 2), _alike(key, F.expr("substring(canon, 5)"), kind, canon, attempt)))
    out = out.when(kind.isin("hex", "ipv6"), _alike(key, canon, kind, canon, attempt, lower="abcdef"))
    out = out.when((kind == "secret") & canon.rlike("^[0-9a-f]+$"), _alike(key, canon, kind, canon, attempt, lower="abcdef"))
    family = F.col("family") if "family" in entities.columns else F.lit(None).cast("string")
    for gender in NAMED:
        givens = F.regexp_extract(canon, "^(.*) [^ ]+$", 1)
        out = out.when(kind == f"family of {gender}", _family(key, gender, canon, attempt))
        out = out.when(kind == gender, F.when(canon.contains(" "), F.concat(_given(key, gender, givens, attempt), F.lit(" "), family)).otherwise(family))
    card = F.concat(F.substring("canon", 1, 1), F.expr("substring(_a_, 2)"))
    return (entities.withColumn("_a_", alike).withColumn("_d_", card)
            .withColumn("surrogate", F.when(kind == "card", _check_digit(F.col("_d_"))).otherwise(out.otherwise(F.col("_a_")))).drop("_a_", "_d_"))


def assign(entities: DataFrame, key: str, attempts: int = 50) -> DataFrame:
    """(kind, canon, surrogate) for distinct ``entities`` (kind, canon): distinct within a kind, and no entity's own value."""
    names, last = F.col("kind").isin(*NAMED), F.element_at(F.split("canon", " "), -1)
    people = entities.filter(names).withColumn("own", F.concat(F.lit("family of "), "kind")).withColumn("last", last)
    families = people.select(F.col("own").alias("kind"), F.col("last").alias("canon")).distinct()
    taken = families.select(F.explode(F.array(*[F.lit(f"family of {g}") for g in NAMED])).alias("kind"), F.col("canon").alias("surrogate"))
    others = entities.filter(~names)
    real = others.select("kind", F.col("canon").alias("surrogate")).union(taken).distinct()
    first = _settle(others.select("kind", "canon").union(families), real, key, attempts)
    settled = first.filter(F.col("kind").startswith("family of ")).select(F.col("kind").alias("own"), F.col("canon").alias("last"), F.col("surrogate").alias("family"))
    people = people.join(settled, ["own", "last"]).select("kind", "canon", "family")
    second = _settle(people, people.select("kind", F.col("canon").alias("surrogate")), key, attempts)
    return first.filter(~F.col("kind").startswith("family of ")).union(second)


def _settle(entities: DataFrame, real: DataFrame, key: str, attempts: int) -> DataFrame:
    """(kind, canon, surrogate) of all entities; no surrogate is twice in a kind or among ``real`` (kind, surrogate)."""
    pending = entities.withColumn("attempt", F.lit(0))
    done = None
    for _ in range(attempts):
        tried = with_surrogates(pending, key)
        free = tried.join(real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        winner = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("canon")) == 1
        new = written(free.withColumn("won", winner).filter("won").select("kind", "canon", "surrogate"), "surrogates")
        done = new if done is None else done.unionByName(new)
        pending = written(pending.join(new, ["kind", "canon"], "left_anti").withColumn("attempt", F.col("attempt") + 1), "collisions")
        if pending.isEmpty():
            return done
    raise RuntimeError(f"surrogates still collide after {attempts} attempts")


def render(kind: Column, mention: Column, canon: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention."""
    chars = F.split(mention, "")
    kept = F.length(F.regexp_replace(mention, r"\D", "")) - F.length(canon)        # a country code stays
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("k"))

    def step(acc, c):
        digit = c.rlike(r"\d")
        new = F.when(~digit | (acc["k"] < kept), c).otherwise(F.substring(surrogate, (acc["k"] - kept + 1).cast("int"), F.lit(1)))
        return F.struct(F.concat(acc["s"], new).alias("s"), (acc["k"] + digit.cast("int")).cast("int").alias("k"))

    digits = F.aggregate(chars, start, step, lambda acc: acc["s"])
    upper = (F.upper(mention) == mention) & mention.rlike(r"\p{L}") & kind.isin("email", "ipv6")
    name = bare(mention)
    named = F.concat(F.expr("substring(mention, 1, length(mention) - length(bare))"), F.when(F.upper(name) == name, F.upper(surrogate)).otherwise(surrogate))
    inside = F.concat(F.expr("substring(mention, 1, locate(canon, mention) - 1)"), surrogate, F.expr("substring(mention, locate(canon, mention) + length(canon))"))
    return (F.when(kind.isin(*DIGITS), digits).when(upper, F.upper(surrogate)).when(kind.isin(*NAMED), named).when(kind == "secret", inside)
            .when((kind == "iban") & mention.contains(" "), F.regexp_replace(surrogate, "(.{4})(?=.)", "$1 ")).otherwise(surrogate))


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with surrogates in their texts, table of all mentions).

    The mentions are (id, ord, kind, mention, canon, surrogate, replacement): one row for each document id, text and
    place.  Documents keep all their columns.
    """
    text = col(text_col)
    flagged = docs.withColumn("_pii_", F.coalesce(text.rlike(HINT) & text.rlike(PATTERN), F.lit(False)))
    some = flagged.filter("_pii_").select(col(id_col).alias("id"), F.xxhash64(text).alias("h"), mentions(text).alias("m"), names_of(text).alias("names"))
    each = some.select("id", "h", "names", F.posexplode("m").alias("ord", "mention")).withColumn("kind", kind_of(F.col("mention"), F.col("names"))).drop("names")
    found = written(each.withColumn("canon", canonical(F.col("kind"), F.col("mention"))).withColumn("bare", bare(F.col("mention"))), "mentions")
    table = assign(found.select("kind", "canon").distinct(), key)
    placed = (found.join(table, ["kind", "canon"])
              .withColumn("replacement", render(F.col("kind"), F.col("mention"), F.col("canon"), F.col("surrogate"))))
    texts = (placed.groupBy(F.col("id").alias("_id_"), F.col("h").alias("_h_")).agg(F.collect_set(F.struct("ord", "replacement")).alias("_new_")))
    held = flagged.filter("_pii_").withColumn("_own_", F.xxhash64(text))
    joined = held.join(texts, col(id_col).eqNullSafe(texts["_id_"]) & (held["_own_"] == texts["_h_"]))
    between = F.split(text, pattern_of(text), -1)
    fresh = F.concat(F.transform(F.array_sort("_new_"), lambda x: x["replacement"]), F.array(F.lit("")))
    whole = F.array_join(F.zip_with(between, fresh, lambda a, b: F.concat(a, b)), "")
    rewritten = joined.select(*[whole.alias(c) if c == text_col else col(c) for c in docs.columns])
    untouched = flagged.filter("not _pii_").select(*all_columns(docs))
    return untouched.unionByName(rewritten), placed.select("id", "ord", "kind", "mention", "canon", "surrogate", "replacement")
