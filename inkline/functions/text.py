"""Text functions: cleaning, token normalisation, keyphrase flags, prompts.

All functions return native Column expressions (regexes in the subset that
Java and RE2 agree on: no lookaround, no back-references, explicit
whitespace classes), so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set: ASCII separators, \x1c-\x1f, NEL and every
# Unicode separator (Zs, Zl, Zp).  Java's \s and RE2's \s disagree on \x0B,
# so the class is spelled out.
WS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"
STRIP_RE = rf"^{WS}+|{WS}+\z"
ALPHA_RE = r"^\p{L}+$"

# --- fixed values -----------------------------------------------------------
# Keyphrases that set the ``gore`` flag, as the reference lists them.
GORE_PHRASES = (
    "gore de la rm",
    "gore metropolitano",
    "gore de santiago",
    "gore de la region metropolitana",
    "gobierno regional metropolitano de santiago",
    "gobierno regional metropolitano",
    "gobernador de la region metropolitana",
    "gobierno metropolitano",
    "gobernador orrego",
    "claudio orrego",
    "gobernador claudio orrego",
    "gobernador de la rm",
)
# Category vocabulary of the classifier, in the reference's order.
CATEGORIES = (
    "Seguridad", "Medioambiente", "Política", "Movilidad", "Economía", "Salud",
    "Educación", "Deportes", "Internacional", "Entretenimiento",
    "Desastres Naturales",
)
OTHER_CATEGORY = "Otro"
# Classifier prompt (instruction, then base), as the reference words it.
PROMPT_INSTRUCTION = (
    "Eres un Clasificador de noticias que categoriza entre 11 categorías "
    "articulos noticiosos. Estas son las categorías que usas para clasificar "
    "con una breve definición:\n"
    "                      Seguridad, Medioambiente, Política, Movilidad, "
    "Economía, Salud, Educación, Deportes, Internacional, Entretenimiento, "
    "Desastres Naturales"
)
PROMPT_BASE = (
    "Para el siguiente artículo dado, por favor declara a cual de las 11 "
    "categorías corresponde la noticia. Si la noticia no corresponde a ninguna "
    "de las categorías retorna \"Otro\". Si la noticia corresponde a dos "
    "categorías retorna ambas categorías.\n"
    "                  La salida para una sola categoría es solo la categoría "
    "encontrada, ej: Seguridad\n"
    "                  La salida para dos categorías son las dos categorias "
    "encontradas separadas por un \";\" en orden de importancia, ej: "
    "Movilidad;Medioambiente"
)
PROMPT_MAX_CHARS = 7500
# Punctuation the tokeniser splits off (brackets, quotes and ?!;@#$%&).
TOKEN_PUNCT = "[](){}<>?!;@#$%&\"«»“”‘’„"
# --- end of fixed values ----------------------------------------------------

# The reference loads its stopword set from a pickle that is not shipped, so
# the list is a parameter.  This default is a short list of very common
# Spanish function words, our own stand-in.
DEFAULT_STOPWORDS = (
    "de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por",
    "un", "para", "con", "no", "una", "su", "al", "lo", "como", "más", "pero",
    "sus", "le", "ya", "o", "este", "sí", "porque", "esta", "entre", "cuando",
    "muy", "sin", "sobre", "también", "me", "hasta", "hay", "donde", "quien",
    "desde", "todo", "nos", "durante", "todos", "uno", "les", "ni", "contra",
    "otros", "ese", "eso", "ante", "ellos", "e", "esto", "antes", "algunos",
    "qué", "unos", "yo", "otro", "otras", "otra", "él", "tanto", "esa",
)


def _punct_class() -> str:
    return "[" + "".join("\\" + ch if ch in "[]\\^-" else ch for ch in TOKEN_PUNCT) + "]"


PUNCT_RE = rf"({_punct_class()}|\.{{2,}}|--)"
COLON_COMMA_RE = r"([:,])([^\d])"
COLON_COMMA_END_RE = r"([:,])\z"
FINAL_DOT_RE = rf"\.({WS}|\z)"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once (and not copied: it is the start of a fold over nothing)."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, use)


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: trim every Unicode whitespace at both ends."""
    return F.regexp_replace(c, STRIP_RE, "")


def clean_text(c: Column) -> Column:
    """Delete newlines (gluing the words around them), then strip."""
    return strip_ws(F.replace(c, F.lit("\n"), F.lit("")))


def tokens(c: Column) -> Column:
    """Tokenise lower-cased text the way the sentence tokeniser splits it.

    Brackets, quotes, ``?!;@#$%&``, dot runs and ``--`` become separate
    tokens; ``:`` / ``,`` split unless a digit follows; a dot before a space or
    the end splits off.  Hyphens, inner dots, slashes and ``¿ ¡`` do not split,
    so ``covid-19``, ``gob.cl`` and ``¿qué`` stay whole (and are not alphabetic).
    """
    x = F.lower(c)
    x = F.regexp_replace(x, PUNCT_RE, " $1 ")
    x = F.regexp_replace(x, COLON_COMMA_RE, " $1 $2")
    x = F.regexp_replace(x, COLON_COMMA_END_RE, " $1 ")
    x = F.regexp_replace(x, FINAL_DOT_RE, " . $1")
    return F.split(x, WS + "+")


def alpha_tokens(c: Column) -> Column:
    """Keep tokens made only of letters (``str.isalpha``)."""
    return F.filter(tokens(c), lambda w: w.rlike(ALPHA_RE))


def remove_stopwords(words: Column, stopwords: Iterable[str] = DEFAULT_STOPWORDS) -> Column:
    """Drop stopwords, keeping duplicates and order (not array_except)."""
    listed = list(stopwords or ())
    if not listed:
        return words
    return F.filter(words, lambda w: ~w.isin(*listed))  # a set test, also for long lists


def normalize_text(c: Column, stopwords: Iterable[str] = DEFAULT_STOPWORDS) -> Column:
    """Lower, tokenise, keep alphabetic tokens, drop stopwords, join by space.

    NULL stays NULL (the reference returns None for non-text input).
    """
    return F.array_join(remove_stopwords(alpha_tokens(c), stopwords), " ")


def contains_any(c: Column, phrases: Sequence[str]) -> Column:
    """OR of plain substring tests: codegen-friendly, no higher-order function."""
    if not phrases:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [c.contains(p) for p in phrases])


def keyphrase_flag(c: Column, phrases: Sequence[str] = GORE_PHRASES) -> Column:
    """1 if the lower-cased text contains any phrase, else 0 (NULL -> 0)."""
    return F.coalesce(contains_any(F.lower(c), phrases), F.lit(False)).cast("int")


def build_prompt(c: Column, max_chars: int = PROMPT_MAX_CHARS) -> Column:
    """T4 + T5: instruction + base + the first ``max_chars`` characters."""
    return F.concat(F.lit(PROMPT_INSTRUCTION + PROMPT_BASE), F.substring(c, 1, max_chars))


def parse_labels(answer: Column, vocab: Sequence[str] = CATEGORIES,
                 strict_reference: bool = False) -> Column:
    """Classifier answer -> struct(category_1, category_2).

    ``A;B`` keeps the first two labels, an unknown label becomes ``Otro`` and a
    repeated label collapses to (A, NULL).  By default each label is stripped
    before the vocabulary test; ``strict_reference=True`` tests the raw piece,
    as the reference does, so ``Movilidad; Salud`` gives (Movilidad, Otro).
    """
    voc = F.array(*[F.lit(v) for v in vocab])
    other = F.lit(OTHER_CATEGORY)
    parts = F.split(answer, ";")
    p1, p2 = F.get(parts, 0), F.get(parts, 1)

    raw1 = p1 if strict_reference else strip_ws(p1)
    raw2 = p2 if strict_reference else strip_ws(p2)
    c1_multi = F.when(F.array_contains(voc, raw1), raw1).otherwise(other)
    c2_multi = F.when(F.array_contains(voc, raw2), raw2).otherwise(other)
    multi = answer.contains(";")
    # a single label is always stripped before the vocabulary test
    single = F.when(F.array_contains(voc, strip_ws(answer)), strip_ws(answer)).otherwise(other)
    cat1 = F.when(answer.isNull(), F.lit(None)).when(multi, strip_ws(c1_multi)).otherwise(single)
    cat2 = F.when(answer.isNull() | ~multi, F.lit(None)).when(
        c1_multi == c2_multi, F.lit(None)).otherwise(strip_ws(c2_multi))
    return F.struct(cat1.cast("string").alias("category_1"), cat2.cast("string").alias("category_2"))


def sentiment_default(c: Column) -> Column:
    """The reference's stub scorer, ('NEU', .5, .5, .5) for text, NULLs otherwise."""
    has = c.isNotNull()
    half = F.when(has, F.lit(0.5).cast("double"))
    return F.struct(F.when(has, F.lit("NEU")).alias("sentiment"),
                    half.alias("pos"), half.alias("neu"), half.alias("neg"))
