"""Language, script and phrase rules for instruction data."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions.messages import text_of
from weir.functions.text import clean_label, is_roman, more_words, normalize_ws
from weir.operators.language import NgramModel, StopWords
from weir.operators.metrics import RowCounts

# Phrases of generated text, by kind.
AI_NAMES = [
    "AI-assistent",
    "AI-gebaseerde assistent",
    "virtuele assistent",
    "digitale assistent",
    "tekst-assistent",
    "AI tekstgebaseerde asssistent",
    "tekstgebaseerde asssistent",
    "assistent",
    "taalmodel",
    "AI-taalmodel",
    "AI taalmodel",
]
BRANDS = ["ChatGPT", "Chat GPT", "GPT3", "GPT 3", "gpt-3", "gpt-3.5-turbo", "GPT4", "GPT 4", "gpt-4", "gpt-4-turbo", "OpenAI", "ShareGPT"]
KNOWLEDGE = [
    "kennisafsluiting in 2023",
    "kennisstop in 2023",
    "kennisafsnijdatum van 2023",
    "cutoff in 2023",
    "Tot mijn kennis die bijgewerkt is tot begin 2023",
    "Voor zover mijn kennis reikt tot 2023",
    "Vanaf mijn kennis tot begin 2023",
    "As of my last update in 2023",
]
WRONG_LANGUAGE = ["It seems like there was a typo", "assistant"]
APOLOGIES = ["spijt me", "spijt mij", "sorry", "mijn excuses"]
TEMPLATES = ["als (?:een )?{}", "ben (?:een )?{}", "{} ben"]


def phrase_pattern(names: list[str] = AI_NAMES, phrases: list[list[str]] | None = None, templates: list[str] = TEMPLATES) -> str:
    """One case-insensitive pattern; names go into the templates, the rest is searched as it is."""
    lists = [BRANDS, KNOWLEDGE, WRONG_LANGUAGE, APOLOGIES] if phrases is None else phrases
    lit = lambda s: re.escape(s).replace(r"\ ", " ")
    parts = [t.format(lit(n)) for n in names for t in templates] + [lit(p) for ps in lists for p in ps]
    return "(?iu)" + "|".join(parts)


def phrase_keys(names: list[str] = AI_NAMES, phrases: list[list[str]] | None = None) -> list[str]:
    """Lower-cased strings one of which is in every text that the pattern of the same lists fits."""
    lists = [BRANDS, KNOWLEDGE, WRONG_LANGUAGE, APOLOGIES] if phrases is None else phrases
    all_ = sorted({p.lower() for ps in (names, *lists) for p in ps}, key=len)
    return [p for i, p in enumerate(all_) if not any(q in p for q in all_[:i])]


def has_phrase(text: Column, pattern: str, keys: list[str] | None = None) -> Column:
    """Whether the pattern fits; with ``keys`` it is tried only where one of them is found, which is much cheaper."""
    fits = text.rlike(pattern)
    return fits if keys is None else F.exists(F.array(folded(text)), lambda low: _contains(low, keys)) & fits


def folded(text: Column) -> Column:
    """Lower case, with the letters that match i, s and k when case is ignored as these."""
    for a, b in ("İi", "ıi", "ſs", "\u212ak"):
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.lower(text)


def _contains(low: Column, keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [low.contains(k) for k in keys], F.lit(False))


def has_listed_phrase(text: Column, names: list[str] = AI_NAMES, phrases: list[list[str]] | None = None) -> Column:
    """Whether ``phrase_pattern`` of the same lists, all of ASCII, fits; null stays null.

    A text is folded once, as the one element of an array.  Phrases are searched as they are; names lead to a pattern of the templates alone,
    without the phrases.
    """
    lists = [BRANDS, KNOWLEDGE, WRONG_LANGUAGE, APOLOGIES] if phrases is None else phrases
    if not all(s.isascii() for ps in (names, *lists) for s in ps):
        raise ValueError("phrases with other than ASCII characters need the pattern")
    one = "(?:" + "|".join(re.escape(n.lower()).replace(r"\ ", " ") for n in names) + ")"
    pattern = "|".join(t.format(one) for t in TEMPLATES)

    def fits(low: Column) -> Column:
        return _contains(low, phrase_keys([], lists)) | (_contains(low, phrase_keys(names, [])) & low.rlike(pattern) if names else F.lit(False))

    return F.when(text.isNotNull(), F.exists(F.array(folded(text)), fits))


Predict = Callable[[str], tuple[str, float]]

# Frequent short words by language label, for the stand-in model.
STOP_WORDS = {
    "nld_Latn": "de het een en van ik je niet dat zijn op te met voor maar ook naar deze wordt".split(),
    "eng_Latn": "the of and to in is that it for was with as on be are this by from".split(),
    "deu_Latn": "der die das und ist nicht ein eine zu den mit von auf sich auch dem".split(),
    "fra_Latn": "le la les des est et un une que qui dans pour pas sur au par".split(),
    "spa_Latn": "el los las que y en un una es por con para del se no su".split(),
}


STAND_IN = StopWords(STOP_WORDS)
Model = NgramModel | StopWords | Callable[[], Predict]


def fasttext_model(path: str) -> Callable[[], Predict]:
    """A factory that loads a model file once per Python worker."""

    def load() -> Predict:
        import fasttext  # not installed everywhere

        model = fasttext.load_model(path)

        def predict(text: str) -> tuple[str, float]:
            labels, probs = model.predict(text, k=1)
            return labels[0], float(probs[0])

        return predict

    return load


def identify_language(df: DataFrame, columns: list[str], model: Model = STAND_IN) -> DataFrame:
    """Adds {column}_lid and {column}_lid_prob; null text gives nulls.

    The stand-in is a Column expression; a fitted model and a factory of a Python function, such as ``fasttext_model``, run in
    Arrow batches, the one Python step of the curation plan.
    """
    for c in columns:
        text = normalize_ws(text_of(c, df.schema[c].dataType))
        got = model.predict(text) if isinstance(model, NgramModel | StopWords) else _in_python(model)(text)
        df = df.withColumn(f"__{c}", got)
        df = df.withColumn(f"{c}_lid", clean_label(F.col(f"__{c}.lid"))).withColumn(f"{c}_lid_prob", F.col(f"__{c}.prob")).drop(f"__{c}")
    return df


def _in_python(factory: Callable[[], Predict]):
    @F.pandas_udf("struct<lid:string,prob:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = factory()
        for s in batches:
            got = [(None, None) if t is None else model(t) for t in s]
            yield pd.DataFrame({"lid": [g[0] for g in got], "prob": pd.array([g[1] for g in got], dtype="Float64")})

    return predict


def language_ok(text: Column, lid: Column, target: str, short: int = 3) -> Column:
    """The language is the target, or the text has at most ``short`` words."""
    return F.coalesce(lid == target, F.lit(False)) | ~F.coalesce(more_words(text, short), F.lit(False))


def quality_filter(df: DataFrame, columns: list[str], target: str | None = "nld_Latn", pattern: str | None = None, roman: bool = True, model: Model = STAND_IN, counts: RowCounts | None = None, normal: bool = False) -> DataFrame:
    """Rows all of whose columns pass: no phrase, Roman letters only, and the language.

    Uses {column}_lid where it exists and identifies the language otherwise.  Cheap rules stand before the model in the plan,
    and languages that are known already before all others unless rows are counted.  ``normal`` says that the texts have single spaces only.
    ``counts`` gets the rows before, after the rules on phrases and letters, and after that on the language, while the result is written.
    """
    missing = [c for c in columns if target is not None and f"{c}_lid" not in df.columns]
    raw = {c: text_of(c, df.schema[c].dataType) for c in columns}
    text = raw if normal else {c: normalize_ws(t) for c, t in raw.items()}

    def bad(t: Column) -> Column:
        phrase = F.coalesce(has_listed_phrase(t) if pattern is None else has_phrase(t, pattern), F.lit(False))
        return phrase | F.coalesce(~is_roman(t), F.lit(False)) if roman else phrase

    mark = (lambda x, _: x) if counts is None else counts.at
    df = mark(df, "rows")
    early = [] if counts is not None or target is None else [c for c in columns if c not in missing]
    for c in early:
        df = df.filter(language_ok(raw[c], F.col(f"{c}_lid"), target))
    for c in columns:  # as the one element of an array the text is normalised once for all rules
        df = df.filter(~F.exists(F.array(text[c]), bad))
    df = mark(df, "phrases and letters")
    full = identify_language(df, missing, model) if missing else df
    for c in [c for c in columns if c not in early] if target is not None else []:
        full = full.filter(language_ok(raw[c], F.col(f"{c}_lid"), target))
    return mark(full, "language").drop(*[f"{c}_{x}" for c in missing for x in ("lid", "lid_prob")])
