"""Pluggable scorers that need Python on executors.

The classifier runs last in the plan, after every filter (filters never move
below a Python UDF), on Arrow batches: the user's ``classify_batch`` gets a
list of texts and returns one answer (or None) per text.  The answer is then
parsed natively by :func:`inkline.functions.text.parse_labels`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkline.functions.text import CATEGORIES, OTHER_CATEGORY, parse_labels

ClassifyBatch = Callable[[list[str]], list]

# Keywords of the deterministic test classifier (our own, not the reference's
# model): a category scores one point per keyword occurrence.
KEYWORDS: dict[str, tuple[str, ...]] = {
    "Seguridad": ("delito", "carabineros", "robo", "policía"),
    "Medioambiente": ("ambiental", "contaminación", "clima", "residuos"),
    "Política": ("gobierno", "ministro", "congreso", "elección"),
    "Movilidad": ("tránsito", "metro", "transporte", "buses"),
    "Economía": ("economía", "precio", "mercado", "empleo"),
    "Salud": ("salud", "hospital", "vacuna", "covid"),
    "Educación": ("colegio", "educación", "estudiantes", "universidad"),
    "Deportes": ("fútbol", "partido", "deporte", "torneo"),
    "Internacional": ("internacional", "extranjero", "mundial", "embajada"),
    "Entretenimiento": ("concierto", "película", "festival", "música"),
    "Desastres Naturales": ("terremoto", "incendio", "inundación", "sismo"),
}


def keyword_classifier() -> ClassifyBatch:
    """A deterministic stand-in for the language-model call: top two categories."""
    order = {c: i for i, c in enumerate(CATEGORIES)}

    def classify_batch(texts: list[str]) -> list[str]:
        out = []
        for t in texts:
            low = t.lower()
            scores = [(sum(low.count(k) for k in kws), c) for c, kws in KEYWORDS.items()]
            hits = sorted([s for s in scores if s[0] > 0], key=lambda s: (-s[0], order[s[1]]))
            if not hits:
                out.append(OTHER_CATEGORY)
            elif len(hits) == 1:
                out.append(hits[0][1])
            else:
                out.append(f"{hits[0][1]};{hits[1][1]}")
        return out

    return classify_batch


def _answers(classify_batch: ClassifyBatch, texts: list[str], max_attempts: int) -> list[tuple[str | None, str | None]]:
    """(answer, why there is none) of each text.

    A text is asked ``max_attempts`` times at most.  An exception or an answer
    list of the wrong length is a failed attempt of all texts in the call; from
    then on texts are asked one by one, so one bad text doesn't cost the others.
    """
    out: list[tuple[str | None, str | None]] = [(None, "no_answer")] * len(texts)
    pending, alone = list(range(len(texts))), False
    for _ in range(max_attempts):
        failed = []
        for call in ([[i] for i in pending] if alone else [pending] if pending else []):
            try:
                got = classify_batch([texts[i] for i in call])
                if len(got) != len(call):
                    raise ValueError(f"{len(got)} answers to {len(call)} texts")
            except Exception as e:  # noqa: BLE001  the classifier is the user's
                got, why = [None] * len(call), f"{type(e).__name__}: {e}"[:200]
                alone = True
            else:
                why = "no_answer"
            for i, answer in zip(call, got, strict=True):
                out[i] = (answer, None if answer is not None else why)
                if answer is None:
                    failed.append(i)
        pending = failed
    return out


def classify(df: DataFrame, text: str = "body", factory: Callable[[], ClassifyBatch] = keyword_classifier,
             max_attempts: int = 2, max_chars: int | None = None,
             vocab: Sequence[str] = CATEGORIES) -> DataFrame:
    """U1 + T7: add ``answer``, ``answer_reason``, ``category_1``, ``category_2``.

    Only the text goes through Arrow (an iterator UDF over one column); the
    classifier is built once per task.  A text without an answer after
    ``max_attempts`` calls has NULL and a reason; so has a NULL text, without a
    call.  ``max_chars`` cuts texts for a classifier with a bounded prompt.
    """

    @F.pandas_udf("answer string, reason string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classify_batch = factory()
        for series in batches:
            there = [i for i, t in enumerate(series) if isinstance(t, str)]
            rows: list[tuple] = [(None, "no_text")] * len(series)
            for i, found in zip(there, _answers(classify_batch, [series.iloc[i][:max_chars] for i in there], max_attempts), strict=True):
                rows[i] = found
            yield pd.DataFrame(rows, columns=["answer", "reason"])

    labels = parse_labels(F.col("answer"), vocab)
    cols = [c for c in df.columns if c not in ("answer", "answer_reason", "category_1", "category_2")]
    out = df.select(*cols, ask(F.col(text)).alias("_a")).select(*cols, F.col("_a.answer").alias("answer"), F.col("_a.reason").alias("answer_reason"))
    return out.select("*", labels["category_1"].alias("category_1"), labels["category_2"].alias("category_2"))


SENTIMENT_TYPE = "struct<sentiment:string,pos:double,neu:double,neg:double>"


def stub_scorer(texts: pd.Series) -> pd.DataFrame:
    """The reference's sentiment stub as a batch scorer."""
    has = texts.map(lambda t: isinstance(t, str))
    half = has.map(lambda h: 0.5 if h else None)
    return pd.DataFrame({"sentiment": has.map(lambda h: "NEU" if h else None),
                         "pos": half, "neu": half, "neg": half})


def sentiment_udf(scorer: Callable[[pd.Series], pd.DataFrame] = stub_scorer):
    """Wrap a batch scorer (Series -> DataFrame of label, pos, neu, neg) as a pandas UDF."""

    @F.pandas_udf(SENTIMENT_TYPE)
    def score(texts: pd.Series) -> pd.DataFrame:
        return scorer(texts)

    return score
