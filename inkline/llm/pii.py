"""PII surrogates: keyed, type-consistent replacements, in DataFrame functions only.

1. One pattern finds entities: e-mail addresses, telephone, card and social
   security numbers, IBANs, IPv4 addresses, secrets given as ``name = value``,
   and person names (after a title, or a known given name before a surname).
   In a text that names a person so, each word of the name (three letters or
   more) counts wherever it stands by itself: ``Dr. Kim Berg ... Berg said``.
   Found places are fenced by a mark and the text is split there, so exactly
   those places are replaced, all at once.
2. An entity is made of units: a number's digits, an address, each word of a
   name.  Units are what stays the same when the writing changes, so
   ``+1 (202) 555-0101``, ``202-555-0101`` and ``1-202-555-0101`` share one, as do
   ``Mrs. Anna Berg`` and ``Berg`` after another title: mentions stay coreferent.
   Whether a word is a given name, and of which gender, is settled once per word
   over all its mentions, so ``Dr. Kim Berg`` and ``Ms. Kim Berg`` are one person.
3. Each distinct unit gets a surrogate from SHA-512 of key, kind, unit and
   attempt, in the unit's own form: digits for digits (a leading country code
   and a card's first digit and Luhn validity stay), ``10.x.x.x`` for
   addresses, the same shape before ``@`` and a reserved domain after it, names
   of the same gender and script built from syllables.
4. Collision check: within a kind no two units may get one surrogate and no
   surrogate may be a unit of the corpus.  Units that collide try again (the
   smallest of those that share a surrogate keeps it); later attempts widen
   the form, so every round has more room and the loop ends.
5. Each occurrence is written in its own format: separators, brackets, titles
   and upper or lower case stay.

Only rows with an entity are shuffled, keyed by the digest of their text, so
copies share the work; distinct values are aggregated map-side before any
shuffle, and joins on values are plain equi-joins that adaptive execution may
split or broadcast by measured size.

Defined results: a null text stays null, an empty one empty; texts without an
entity come back unchanged; each row gives one row, equal or null ids
included, with all its columns; a table without any entity needs no round.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkline.llm.scratch import written

# --- fixed values: titles, common given names, and the syllables that surrogates are made of ---
TITLES_F = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Señorita", "Sra", "Srta", "Madame", "Mademoiselle", "Mme", "Mlle", "Signora", "Госпожа", "г-жа")
TITLES_M = ("Mr", "Mister", "Sir", "Herr", "Señor", "Sr", "Monsieur", "Signor", "Господин", "г-н")
TITLES_N = ("Dr", "Prof")
GIVEN_F = ("Alice", "Anna", "Anne", "Barbara", "Carmen", "Catherine", "Charlotte", "Claire", "Elizabeth", "Emily", "Emma", "Ingrid", "Isabel", "Jane", "Jennifer", "Julia", "Katharina", "Laura", "Linda", "Lucia", "Margaret", "Maria", "Marie", "María", "Mary", "Patricia", "Sarah", "Sofia", "Sophie", "Susan", "Анна", "Елена", "Мария", "Ольга")
GIVEN_M = ("Alexander", "Andrew", "Antonio", "Carlos", "Charles", "Daniel", "David", "Francisco", "François", "Hans", "James", "Jean", "John", "José", "Juan", "Jürgen", "Klaus", "Louis", "Luis", "Michael", "Paul", "Peter", "Philippe", "Pierre", "Richard", "Robert", "Thomas", "Wolfgang", "William", "Александр", "Дмитрий", "Иван", "Сергей")
SYLLABLES = {"latin": ("ba", "ca", "de", "do", "fe", "ga", "ha", "jo", "ka", "le", "li", "lo", "ma", "mi", "na", "ne", "no", "pa", "re", "ri", "ro", "sa", "se", "so", "ta", "te", "to", "va", "ve", "vi", "ya", "za"),
             "cyrillic": ("ба", "ва", "ве", "во", "га", "да", "де", "до", "жа", "за", "зе", "ка", "ко", "ла", "ле", "ли", "ма", "ме", "ми", "на", "не", "но", "па", "по", "ра", "ре", "ро", "са", "се", "со", "та", "то"),
             "greek": ("βα", "βε", "γα", "γε", "δα", "δε", "δο", "ζα", "θα", "θε", "κα", "κο", "λα", "λε", "λι", "μα", "με", "μι", "να", "νε", "νο", "πα", "πε", "πο", "ρα", "ρε", "ρο", "σα", "σε", "τα", "τε", "το")}
ENDINGS = {"latin": {"f": "lina", "m": "ton", "n": "ren", "s": "sen"}, "cyrillic": {"f": "лина", "m": "тон", "n": "рен", "s": "сен"}, "greek": {"f": "λινα", "m": "τος", "n": "ρις", "s": "σης"}}
# --- end of fixed values ---

#: A word of a name: a quote or hyphen belongs to it between letters, but not the one of a genitive (``Berg's``).
NAME = r"\p{Lu}(?:\p{L}|['’-](?=\p{L}{2}))+"
_TITLES = "|".join((*TITLES_F, *TITLES_M, *TITLES_N))
_GIVEN = "|".join((*GIVEN_F, *GIVEN_M))
SECRET_NAMES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key")
SECRET_LEAD = f"(?i:{'|'.join(SECRET_NAMES)}) {{0,2}}[=:] {{0,2}}[\"']?"
SECRET_BODY = r"[\p{L}\p{N}_+/.-]{8,}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: A blank before a further group of a telephone number, unless an address or social security number begins there.
_GAP = rf"(?: (?!{_OCTET}(?:\.{_OCTET}){{3}}(?!\d)(?!\.\d)|\d{{3}}-\d{{2}}-\d{{4}}(?![\d-]))|[.-])?"
_TEN = r"\d[ .()-]{0,3}" * 10  # written out, as Java's look-behind takes no count of a group
#: After ``+``: ten digits after 1 or 7; three and four after another country's bracketed area code; else groups until ten digits are there, and a last short one that no digits follow.
_ABROAD = (r"[17][ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{2}[ .-]?\d{2}(?!\d)|\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
           rf"|\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?\d{{2,4}}(?:{_GAP}(?<!{_TEN})\d{{2,4}})+(?:[ .-]?(?:\d{{2}}(?![.-]?\d)|\d{{3}}(?![ .-]?\d)))?(?!\d)")
#: Kind and pattern; of two that match at one place the first counts.  Each begins with what is cheap to refuse, as it is tried at every character.
KINDS = (
    ("email", r"[\p{L}\p{N}](?<![\p{L}\p{N}]{2})[\p{L}\p{N}._%+-]*+@[\p{L}\p{N}][\p{L}\p{N}-]*(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"),
    ("ip", rf"(?=\d)(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d)(?!\.\d)"),
    ("ssn", r"(?=\d)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", rf"(?=[\d(+])(?:(?<![\d+])\+(?:{_ABROAD})" r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-]))"),
    ("card", r"(?=\d)(?<![\d.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"),
    ("iban", r"(?=[A-Z]{2}\d)(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])"),
    ("secret", rf"(?=[tspaTSPA])(?<![\p{{L}}\p{{N}}]){SECRET_LEAD}{SECRET_BODY}"),
    ("name", rf"(?=[\p{{Lu}}г])(?<![\p{{L}}\p{{N}}])(?:(?:{_TITLES})\.? {NAME}(?: {NAME}){{0,2}}|(?:{_GIVEN}) {NAME})"),
)
PATTERN = dict(KINDS)
ANY = "|".join(f"(?:{p})" for _, p in KINDS)
_NUMBERS = "|".join(f"(?:{PATTERN[k]})" for k in ("ip", "ssn", "phone", "card", "iban"))
#: Fence around an entity: a private-use character and a second mark.  Where a text holds that character itself, it gets another second mark.
FENCE, OWN, HERE = "\ue000", "\ue000\ue001", "\ue000\ue002"
#: Attempts in the unit's own form; each later one adds a digit or syllable.
NARROW = 4


def has_entity(text: Column) -> Column:
    """Whether any kind is found; a kind's pattern only runs on texts with a character or word that it needs."""
    secret = text.contains("=") | text.contains(":")
    found = (text.contains("@") & text.rlike(PATTERN["email"])) | (text.rlike(r"\d\d|\d\.\d") & text.rlike(_NUMBERS))
    return F.coalesce(found | (secret & text.rlike(PATTERN["secret"])) | text.rlike(PATTERN["name"]), F.lit(False))


def segments(text: Column, persons: Column | None = None) -> Column:
    """The text's parts: plain ones at even places, entities at odd ones; ``persons`` are words that count wherever they stand by themselves."""
    owned = F.replace(text, F.lit(FENCE), F.lit(OWN))
    fenced = F.regexp_replace(owned, ANY, f"{HERE}$0{HERE}")
    if persons is not None:
        bare = F.concat(F.lit(rf"{ANY}|(?<![\p{{L}}\p{{N}}])(?:"), F.array_join(persons, "|"), F.lit(r")(?![\p{L}\p{N}])"))
        fenced = F.when(F.size(persons) == 0, fenced).otherwise(F.regexp_replace(owned, bare, F.lit(f"{HERE}$0{HERE}")))
    return F.transform(F.split(fenced, HERE), lambda s: F.replace(s, F.lit(OWN), F.lit(FENCE)))


def persons_of(values: Column) -> Column:
    """Words of the names among a text's entities, without titles, longest first; those of one or two letters are too often other words."""
    names = F.filter(values, lambda v: v.rlike(f"^(?:{PATTERN['name']})$"))
    words = F.array_distinct(F.flatten(F.transform(names, lambda v: F.split(v, " "))))
    kept = F.filter(words, lambda w: w.rlike(f"^{NAME}$") & (F.length(w) > 2) & ~w.isin(*TITLES_F, *TITLES_M, *TITLES_N))
    return F.transform(F.sort_array(F.transform(kept, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))), asc=False), lambda s: s["w"])


def entities(parts: Column) -> Column:
    return F.array_distinct(F.filter(parts, lambda s, i: i % 2 == 1))


def kind_of(value: Column) -> Column:
    """Kind of an entity by itself."""
    other = F.when(value.rlike(f"^{NAME}$"), "name").otherwise("secret")  # a person's word by itself
    return reduce(lambda rest, k: F.when(value.rlike(f"^(?:{k[1]})$"), F.lit(k[0])).otherwise(rest), reversed(KINDS), other)


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def number_of(value: Column) -> Column:
    """A telephone number as ``+`` and its digits; ten digits, or eleven that begin with 1, without ``+`` are of country 1."""
    digits = F.regexp_replace(value, r"\D", "")
    return F.when(value.startswith("+") | (F.length(digits) == 11), F.concat(F.lit("+"), digits)).otherwise(F.concat(F.lit("+1"), digits))


def units_of(value: Column, kind: Column) -> Column:
    """Array of (kind, canon, role) of an entity; names give one for each word but the title.

    A word's role is what its place says of it: ``0f`` or ``1m`` for a given name by the list or the title, ``2n`` for one of unknown gender, ``3s`` for a surname.
    """
    digits = F.regexp_replace(value, r"\D", "")
    canon = F.when(kind == "email", F.lower(value)).when(kind == "phone", number_of(value)).when(kind.isin("ssn", "card"), digits).when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).when(kind == "secret", F.regexp_replace(value, f"^{SECRET_LEAD}", "")).otherwise(value)
    words = F.split(value, " ")
    title = F.regexp_replace(words[0], r"\.$", "")
    titled = title.isin(*TITLES_F, *TITLES_M, *TITLES_N) & ~title.isin(*GIVEN_F, *GIVEN_M)
    sex = F.when(title.isin(*TITLES_F), "0f").when(title.isin(*TITLES_M), "1m").otherwise("2n")
    names = F.when(titled, F.slice(words, 2, 4)).otherwise(words)

    def unit(word: Column, at: Column) -> Column:
        listed = F.when(word.isin(*GIVEN_F), "0f").when(word.isin(*GIVEN_M), "1m")
        role = F.coalesce(listed, F.when(at == F.size(names) - 1, "3s").otherwise(sex))
        return F.struct(F.concat(F.lit("name:"), script_of(word)).alias("kind"), F.lower(word).alias("canon"), role.alias("role"))

    return F.when(kind == "name", F.transform(names, unit)).otherwise(F.array(F.struct(kind.alias("kind"), canon.alias("canon"), F.lit("").alias("role"))))


def valid(number: Column) -> Column:
    """Whether the last digit is the Luhn check digit."""
    return F.call_function("luhn_check", number)


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """What stands for a unit at an attempt."""
    seed = lambda *salt: F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"), *map(F.lit, salt)), 512)
    h = seed()
    number = lambda x, at: F.conv(F.substring(x, at, 15), 16, 10).cast("long")
    many = F.concat(*(F.lpad((number(h, 1 + 15 * i) % 10**15).cast("string"), 15, "0") for i in range(4)))
    digits = lambda n: F.substring(many, F.lit(1), n)
    size = F.length(canon)
    wide = F.greatest(attempt - NARROW, F.lit(0)).cast("int")  # characters more than the unit's own form

    def shaped(text: Column) -> Column:
        """A letter for a letter, a digit for a digit."""
        def one(c: Column, i: Column) -> Column:
            byte = F.conv(F.substring(h, 1 + 2 * (i % 64), F.lit(2)), 16, 10).cast("int") + i.cast("int")
            return F.when(c.rlike("^[0-9]$"), (byte % 10).cast("string")).when(c.rlike("^[a-z]$"), F.char(F.lit(97) + byte % 26)).when(c.rlike("^[A-Z]$"), F.char(F.lit(65) + byte % 26)).when(c.rlike(r"^\p{L}$"), F.char(F.lit(97) + byte % 26)).otherwise(c)
        return F.array_join(F.transform(F.split(text, ""), one), "")

    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    host = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), domain), 256)
    label = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.char(F.lit(97) + F.conv(F.substring(host, 1 + 2 * i, F.lit(2)), 16, 10).cast("int") % 26)), "")
    email = F.concat(shaped(local), digits(F.greatest(attempt - 1, F.lit(0)).cast("int")), F.lit("@"), label, F.lit(".example."), F.substring_index(domain, ".", -1))

    octet = lambda k: (F.conv(F.substring(h, 1 + 4 * k, 4), 16, 10).cast("int") % 254 + 1).cast("string")
    ip = F.when(attempt < NARROW, F.concat_ws(".", F.lit("10"), octet(1), octet(2), octet(3))).otherwise(F.concat(F.lit("2001:db8"), *(x for k in range(6) for x in (F.lit(":"), F.substring(h, 1 + 4 * k, 4)))))

    keep = F.when(~canon.startswith("+"), 0).when(canon.rlike(r"^\+[17]"), 2).otherwise(3)
    phone = F.concat(F.substring(canon, F.lit(1), keep), digits((size - keep + wide).cast("int")))
    ssn = F.concat(F.lit("9"), digits(F.lit(8) + wide))
    body = F.concat(F.substring(canon, 1, 1), digits((size - 2 + wide).cast("int")))
    check = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(body, d.cast("string"))), valid)[0]
    last = F.concat(body, F.substring(many, 59, 1))
    card = F.when(valid(canon), check).otherwise(last)
    iban = F.concat(F.substring(canon, 1, 2), shaped(F.substring(canon, F.lit(3), size)), digits(wide))
    hexa = F.substring(F.repeat(h, 1 + F.floor(size / 128).cast("int")), F.lit(1), size)
    hexes = F.when(canon.rlike("^[0-9a-f]+$"), hexa).when(canon.rlike("^[0-9A-F]+$"), F.upper(hexa)).otherwise(shaped(canon))
    secret = F.concat(hexes, digits(wide))

    parts = F.split(kind, ":")
    def name(script: str) -> Column:
        table = F.array(*map(F.lit, SYLLABLES[script]))
        at = lambda i: F.conv(F.substring(h, 1 + 2 * (i % 64), F.lit(2)), 16, 10).cast("int") % len(SYLLABLES[script])
        stem = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(1) + attempt.cast("int")), lambda i: F.get(table, at(i))), "")
        ending = reduce(lambda rest, e: F.when(parts[1] == e[0], F.lit(e[1])).otherwise(rest), ENDINGS[script].items(), F.lit(""))
        return F.concat(stem, ending)
    person = F.when(parts[2] == "cyrillic", name("cyrillic")).when(parts[2] == "greek", name("greek")).otherwise(name("latin"))
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "ssn", ssn).when(kind == "card", card).when(kind == "iban", iban).when(kind == "secret", secret).otherwise(person)


def space_of(kind: Column) -> Column:
    """Units of one space must stay distinct: a kind, or all names of persons together."""
    return F.when(kind.startswith("name:"), "name").otherwise(kind)


def resolve(units: DataFrame, key: str) -> DataFrame:
    """kind, canon, surrogate of distinct units: no surrogate twice in a space, none that is a unit."""
    units = written(units.withColumn("space", space_of(F.col("kind"))), "units")
    originals = units.select("space", F.col("canon").alias("surrogate")).distinct()
    settled, pending, attempt = None, units, 0
    while True:
        tried = pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("canon"), F.lit(attempt), key))
        free = tried.join(originals, ["space", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["space", "surrogate"], "left_anti")
        first = free.groupBy("space", "surrogate").agg(F.min(F.struct("kind", "canon")).alias("unit"))
        good = first.select("space", "surrogate", "unit.kind", "unit.canon")
        now = written(good if settled is None else settled.unionByName(good), "settled")
        rest = written(units.join(now, ["kind", "canon"], "left_anti"), "pending")
        settled, pending, attempt = now, rest, attempt + 1
        if rest.isEmpty():
            return settled.select("kind", "canon", "surrogate")


def filled(value: Column, digits: Column) -> Column:
    """The value with its digits taken in order from ``digits``; what is left over goes to the end."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    step = lambda acc, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(acc["out"], F.substring(digits, acc["n"] + 1, F.lit(1))).alias("out"), (acc["n"] + 1).alias("n"))).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["n"].alias("n")))
    return F.aggregate(F.split(value, ""), start, step, lambda acc: F.concat(acc["out"], F.substring(digits, acc["n"] + 1, F.length(digits))))


def cased(word: Column, like: Column) -> Column:
    upper = (F.length(like) > 1) & (like == F.upper(like))
    return F.when(upper, F.upper(word)).otherwise(F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, F.lit(2), F.length(word))))


def written_like(value: Column, kind: Column, found: Column) -> Column:
    """The replacement of one occurrence: ``found`` holds its units' surrogates in order."""
    words = F.split(value, " ")
    skip = F.size(words) - F.size(found)
    person = F.array_join(F.transform(words, lambda w, i: F.when(i < skip, w).otherwise(cased(F.get(found, (i - skip).cast("int")), w))), " ")
    spaced = F.rtrim(F.regexp_replace(found[0], "(.{4})", "$1 "))
    abroad = (kind == "phone") & (F.length(F.regexp_replace(value, r"\D", "")) == 10) & ~value.startswith("+")  # written without its country's 1
    number = filled(value, F.substring(F.replace(found[0], F.lit("+"), F.lit("")), F.when(abroad, 2).otherwise(1), F.length(found[0])))
    email = F.when((F.upper(value) == value) & value.rlike("[A-Z]"), F.upper(found[0])).otherwise(found[0])
    return F.when(kind == "name", person).when(kind.isin("phone", "ssn", "card"), number).when((kind == "iban") & value.contains(" "), spaced).when(kind == "email", email).when(kind == "secret", F.concat(F.regexp_extract(value, f"^{SECRET_LEAD}", 0), found[0])).otherwise(found[0])


def replacements(values: DataFrame, key: str) -> DataFrame:
    """value, replacement of distinct entity values."""
    kind = kind_of(F.col("value"))
    typed = written(values.withColumn("kind", kind).withColumn("units", units_of(F.col("value"), F.col("kind"))), "values")
    each = typed.select("value", F.col("kind").alias("as"), F.posexplode("units").alias("at", "unit")).select("value", "as", "at", "unit.kind", "unit.canon", "unit.role")
    # a word has one role in the corpus, the first that any mention gives it, and so one surrogate whatever the title
    words = each.groupBy("kind", "canon").agg(F.min("role").alias("role"))
    person = F.concat_ws(":", F.lit("name"), F.substring("role", 2, 1), F.substring_index("kind", ":", -1))
    chosen = resolve(words.select(F.when(F.col("role") != "", person).otherwise(F.col("kind")).alias("kind"), "canon"), key)
    chosen = chosen.withColumn("kind", F.when(F.col("kind").startswith("name:"), F.concat(F.lit("name:"), F.substring_index("kind", ":", -1))).otherwise(F.col("kind")))
    ready = each.join(chosen, ["kind", "canon"]).groupBy("value", "as").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "surrogate"))), lambda u: u["surrogate"]).alias("found"))
    return ready.select("value", written_like(F.col("value"), F.col("as"), F.col("found")).alias("replacement"))


def anonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with entities in ``text_col`` replaced; ``count_col``: name of a column with the number of places, in place of one that has the name."""
    if not key:
        raise ValueError("a key is needed")
    own, tag = [c for c in docs.columns if c != count_col], uuid.uuid4().hex[:8]
    found, at = has_entity(F.col(f"`{text_col}`")), f"digest_{tag}"
    digest = F.sha2(F.col(f"`{text_col}`"), 256)
    hit = docs.filter(found)
    text = F.col(f"`{text_col}`")
    each = hit.select(digest.alias(at), entities(segments(text, persons_of(entities(segments(text))))).alias("values"))
    listed = written(each.dropDuplicates([at]), "entities")  # rows of one digest hold the same values
    value = listed.select(at, F.explode("values").alias("value"))
    by = replacements(value.select("value").distinct(), key)
    lookup = value.join(by, "value").groupBy(at).agg(F.map_from_entries(F.collect_list(F.struct("value", "replacement"))).alias("by"))
    parts, swap = f"parts_{tag}", f"by_{tag}"
    joined = hit.withColumn(at, digest).join(lookup.withColumnRenamed("by", swap), at).withColumn(parts, segments(text, persons_of(F.map_keys(swap))))
    new = F.array_join(F.transform(F.col(parts), lambda s, i: F.when(i % 2 == 1, F.element_at(F.col(swap), s)).otherwise(s)), "")
    extra = [count_col] if count_col else []
    if count_col:
        joined = joined.withColumn(count_col, F.floor(F.size(parts) / 2).cast("long"))
    changed = joined.withColumn(text_col, new).select(*(f"`{c}`" for c in own + extra))
    same = docs.filter(~found)
    if count_col:
        same = same.withColumn(count_col, F.lit(0).cast("long"))
    return same.select(*(f"`{c}`" for c in own + extra)).unionByName(changed)
