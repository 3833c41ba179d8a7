"""The features of toxicity scores, from the whole text alone.

Densities of lexicon words by class, how close they stand to the second person, capitals,
punctuation, and how much of it is obfuscated (letters replaced, doubled, or spaced out). One
more lexicon is learnt: word beginnings that labelled toxic texts have far more often than
others, which covers languages and slang that no list has. It is learnt from a bounded
sample of labelled rows.

Python workers import this module, and so not the model's libraries.
"""

from __future__ import annotations

import bisect
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import in_tasks, labelled_sample, over_texts
from meterstar.scratch import staged

# Word lists (fixed values), lower case, by class. Words that are ordinary in one of the
# other languages ("die", "mist", "gift") are left out.
LEXICON = {
    "insult": """
        idiot idiots idiotic moron morons moronic stupid dumb dumbass fool imbecile cretin loser
        losers clown clowns jerk creep freak trash garbage scum scumbag filth vermin pathetic
        worthless disgusting useless ugly coward liar pig rat parasite degenerate braindead
        trottel dummkopf dumm blöd blödmann vollidiot schwachkopf versager abschaum wertlos
        ekelhaft erbärmlich nichtsnutz drecksack widerlich
        idiote imbécile crétin débile abruti ordure minable pathétique dégoûtant dégueulasse
        inutile raté bouffon connard
        idiota imbécil estúpido estúpida tonto tonta basura escoria perdedor payaso patético
        asqueroso inútil cobarde cretino""",
    "profanity": """
        damn bullshit shit shitty fuck fucking fucked fucker asshole bastard bitch crap piss
        scheiße scheisse arschloch verdammt merde putain salaud mierda joder puta cabrón""",
    "threat": """
        kill killed murder shoot stab strangle lynch beat destroy hurt punish exterminate
        umbringen töten erschießen schlagen vernichten tuer crever frapper détruire massacrer
        matar golpear destruir asesinar""",
    "hate": "hate hated despise loathe hass hasse verachte haïr hais déteste odio odiar detesto",
}
SECOND_PERSON = set("you your yours yourself ya u ur du dich dir dein deine ihr euch tu te toi ton"
                    " vous votre vos tú ti tus usted ustedes vosotros vuestra".split())
CLASS_OF = {w: i for i, words in enumerate(LEXICON.values()) for w in words.split()}
NEAR = 5  # words

# Stand-ins for letters, and letters of other scripts that look the same.
STAND_INS = str.maketrans("013457@$!|", "oieastasii")
LOOK_ALIKES = str.maketrans("аеорсхуіѕԁⅼ", "aeopcxyisdl")
TOKEN = re.compile(r"[@$]?\w+(?:[@$!*]\w+)*")
TRIPLE = re.compile(r"(\w)\1\1+")
SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?!\w)")
NOT_LETTERS = re.compile(r"[\W\d_]+")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
MARKS = re.compile(r"[!?]{2,}")
HIDDEN = re.compile("[­​-‏⁠﻿]")

FEATURES = (
    *[f"{c}_density" for c in LEXICON], *[f"{c}_count" for c in LEXICON],
    "lexicon_distinct", "obfuscated_density", "obfuscated_count", "second_person_density",
    "near_second_person", "capital_rate", "shouted_rate", "exclamation_rate", "question_rate",
    "mark_run_rate", "punctuation_rate", "digit_rate", "symbol_rate", "hidden_rate",
    "lengthened_rate", "log_words", "word_length", "stem_density", "stem_count", "stem_distinct",
)

# The learnt lexicon: beginnings of 4 to 8 letters, from at most so many labelled texts of
# either label; at least so many toxic texts, and so much more often, must have one.
STEM_LENGTHS = (4, 5, 6, 7, 8)
STEM_TEXTS, STEM_SUPPORT, STEM_SHARE, STEM_RATIO, STEMS = 4000, 4, 0.002, 20.0, 2000


def _wildcards(word: str) -> int | None:
    """The class of a lexicon word that a word with asterisks can stand for."""
    pattern = re.compile(re.escape(word).replace(r"\*", r"\w"))
    return next((c for w, c in CLASS_OF.items() if len(w) == len(word) and pattern.fullmatch(w)), None)


class Stems:
    """Word beginnings, none of which begins with another."""

    def __init__(self, stems: list[str]) -> None:
        self.heads = {s[: STEM_LENGTHS[0]] for s in stems}
        self.stems = set(stems)

    def of(self, word: str) -> str | None:
        if word[: STEM_LENGTHS[0]] in self.heads:
            for n in STEM_LENGTHS:
                if word[:n] in self.stems:
                    return word[:n]
        return None


def features(text: str | None, stems: Stems) -> list[float]:
    """The features of a text, in the order of FEATURES; an empty text has all zeros."""
    text = text or ""
    hidden = len(HIDDEN.findall(text)) if not text.isascii() else 0
    plain = HIDDEN.sub("", text) if hidden else text
    lower = plain.lower()
    words = TOKEN.findall(lower)
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    hits = [(i, CLASS_OF[w]) for i, w in enumerate(words) if w in CLASS_OF]
    distinct = {words[i] for i, _ in hits}
    masked = []
    for i, w in enumerate(words):
        if w.isalpha() and w.isascii() or w in CLASS_OF or w.isdigit():
            continue
        found = None
        if not w.isalpha():
            letters = NOT_LETTERS.sub("", w.translate(STAND_INS))
            found = _wildcards(w) if "*" in w else CLASS_OF.get(letters) if len(letters) > 3 else None
        elif "Ѐ" <= max(w) <= "ⅿ":
            found = CLASS_OF.get(w.translate(LOOK_ALIKES))
        if found is not None:
            masked.append((i, found))
    lengthened = 0
    if TRIPLE.search(lower):
        for i, w in enumerate(words):
            if w not in CLASS_OF and TRIPLE.search(w) and w[0].isalpha():
                lengthened += 1
                once, twice = TRIPLE.sub(r"\1", w), TRIPLE.sub(r"\1\1", w)
                found = CLASS_OF.get(once, CLASS_OF.get(twice))
                if found is not None:
                    masked.append((i, found))
    starts = None
    for m in SPACED.finditer(lower):
        found = CLASS_OF.get(NOT_LETTERS.sub("", m[0]))
        if found is not None:
            starts = starts or [t.start() for t in TOKEN.finditer(lower)]
            # The words before it; a sign that its first letter made a word is none.
            before = bisect.bisect_left(starts, m.start())
            sign = before and starts[before - 1] == m.start() - 1 and lower[m.start() - 1] in "@$"
            masked.append((before - bool(sign), found))
    every = hits + masked
    heads, size = stems.heads, STEM_LENGTHS[0]
    stemmed = [x for x in (stems.of(w) for w in words if w[:size] in heads) if x]
    by_class = [sum(1 for _, c in every if c == k) for k in range(len(LEXICON))]
    person = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if every and person:
        at, hit = np.array(person), np.array([i for i, _ in every])
        after = np.searchsorted(at, hit)
        right, left = at[np.minimum(after, len(at) - 1)], at[np.maximum(after - 1, 0)]
        near = int((np.minimum(np.abs(right - hit), np.abs(left - hit)) <= NEAR).sum())
    data = np.frombuffer(plain.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(data, minlength=256)
    capitals = int(counts[65:91].sum())
    letters = max(1, capitals + int(counts[97:123].sum()))
    punctuation = sum(int(counts[ord(c)]) for c in ".,;:'\"()-")
    symbols = sum(int(counts[ord(c)]) for c in "#*$%&|<>@^~_=+\\/[]{}")
    return [
        *(100 * c / n for c in by_class), *(math.log1p(c) for c in by_class),
        float(len(distinct)), 100 * len(masked) / n, math.log1p(len(masked)), 100 * len(person) / n,
        math.log1p(near), capitals / letters, len(SHOUTED.findall(plain)) / n,
        float(counts[33]) / chars, float(counts[63]) / chars, len(MARKS.findall(plain)) / n,
        punctuation / chars, float(counts[48:58].sum()) / chars, symbols / chars, hidden / chars,
        lengthened / n, math.log(n), sum(map(len, words)) / n,
        100 * len(stemmed) / n, math.log1p(len(stemmed)), float(len(set(stemmed))),
    ]


def beginnings(text: str | None) -> set[str]:
    words = set(TOKEN.findall((text or "").lower()))
    return {w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n}


def learn_stems(docs: DataFrame, labelled: DataFrame, texts: int = STEM_TEXTS) -> Stems:
    """Stems from `docs` (id, text) and `labelled` (id, label 0 or 1).

    At most about `texts` texts of either label are read, chosen by a hash of id and text.
    """
    rows = labelled_sample(docs, labelled, texts, by_label=True).select("label", "text")

    def count(batches):
        counts: dict[str, list[int]] = {}
        seen = [0, 0]
        for batch in batches:
            for label, text in zip(*(c.to_pylist() for c in batch.columns)):
                seen[label] += 1
                for b in beginnings(text):
                    counts.setdefault(b, [0, 0])[label] += 1
        counts[""] = seen
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts)), *(pa.array([v[k] for v in counts.values()], pa.int64()) for k in (0, 1))],
            names=["stem", "clean", "toxic"],
        )

    counted = staged(
        in_tasks(rows, count, "stem string, clean bigint, toxic bigint")
        .groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
        "stems",
    )
    totals = counted.filter("stem = ''").first()
    if not totals or not totals["clean"] or not totals["toxic"]:
        return Stems([])
    support = max(STEM_SUPPORT, STEM_SHARE * totals["toxic"])
    rate = F.col("toxic") / totals["toxic"], (F.col("clean") + 0.5) / totals["clean"]
    best = (
        counted.filter((F.col("stem") != "") & (F.col("toxic") >= support) & (rate[0] > STEM_RATIO * rate[1]))
        .orderBy(F.desc("toxic"), F.length("stem"), "stem").limit(STEMS).collect()
    )
    kept: set[str] = set()
    for stem in sorted((r["stem"] for r in best), key=len):
        if not any(stem[:n] in kept for n in STEM_LENGTHS if n < len(stem)):
            kept.add(stem)
    return Stems(sorted(kept))


def with_features(docs: DataFrame, text_column: str, name: str, stems: Stems) -> DataFrame:
    """`docs` with the array `name` of features."""
    def make():
        def run(batch: pa.RecordBatch) -> dict:
            texts = batch.column(batch.schema.get_field_index(text_column)).to_pylist()
            return {name: pa.array([features(t, stems) for t in texts], pa.list_(pa.float64()))}

        return run

    return over_texts(docs, text_column, f"`{name}` array<double>", make, keep=True)
