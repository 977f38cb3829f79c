"""Toxicity by a weighted pattern grammar over clauses.

Two transducers are composed. The first reads words and writes classes: insult (with the
learned weight of its stem), threat, target, negation, reported speech, other. The second reads
the classes of a clause and writes a weight for each matched pattern: an insult or threat counts
as learned, more beside a target, less under negation, less again inside reported speech. A
document's score sums up its clauses, so single words count only through the clause they are in.

Insult stems and their weights are learned: of the labelled rows that may be used, the
``most_labelled`` of each label with the smallest hash of their id are looked at, and a stem (a
whole word of any length, or the first four to ``LONGEST`` letters of one) is taken if the texts
that hold it are nearly all toxic and a share of the toxic texts of some language holds it. Texts
count once, however many copies there are. Rows whose crc32(doc_id as text) mod 3 is 1 are held out from learning.

Defined results: a null or empty text has the score of a text without matches; a null label or
id takes no part in learning; repeated labels count once; without any toxic label no stem is
learned and threats alone score; ties are broken by stem and by id.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.shared import Batches, arrow_map, written

#: Words of the closed classes, for four languages.
TARGETS = (
    "you your yours u he she him her his they them their we us "
    "tu toi te vous il elle ils elles eux leur lui du dich dir ihr euch er sie ihm ihn ihnen "
    "usted ustedes él ella ellos ellas le les"
).split()
NEGATIONS = "not no never none nor isn't aren't wasn't don't pas jamais aucun nicht kein keine nie nunca jamás ni".split()
REPORTS = (
    "said says say called calls wrote claimed quoted dit disait écrit sagt sagte schrieb nannte dijo dice "
    "llamó escribió"
).split()
THREATS = (
    "kill murder stab strangle shoot behead tuer égorger poignarder töten umbringen erschießen matar apuñalar"
).split()

THREAT_WEIGHT = 2.0
BESIDE_TARGET = 1.25
NEGATED = 0.7
REPORTED = 0.8
#: Bound of the sample for learning, for each of the two labels.
MOST_LABELLED = 8_000
#: Letters of a stem that other letters may follow; a whole word is a stem whatever its length.
SHORTEST, LONGEST = 4, 32
#: Closes a stem that is a whole word.
END = " "
LEAST_TOXIC_DOCS = 5
#: Share of the distinct toxic texts of a language that hold a stem.
LEAST_SUPPORT = 0.025
LEAST_PURITY = 0.97
MOST_STEMS = 50_000
#: Stems a task counts before it passes them on.
_COUNTED = 500_000
#: Score of a document with a sum of clause weights s: 1 / (1 + exp(-(SLOPE * s + LEVEL))).
SLOPE, LEVEL = 1.0, -2.5
THRESHOLD = 0.7
HELD_OUT = 1

SCORES = "doc_id long, held_out boolean, score double, predicted int, clauses int"

_CLAUSES = re.compile(r"[.!?;\n]+")
_WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
INSULT, THREAT, TARGET, NEGATION, REPORT = range(1, 6)


class WordTransducer:
    """Words to (class, weight)."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.lengths = sorted({len(s) for s in stems})
        self.closed = {w: (TARGET, 0.0) for w in TARGETS}
        self.closed |= {w: (NEGATION, 0.0) for w in NEGATIONS}
        self.closed |= {w: (REPORT, 0.0) for w in REPORTS}
        self.closed |= {w: (THREAT, THREAT_WEIGHT) for w in THREATS}
        first = sorted({s.removesuffix(END)[:SHORTEST] for s in stems} | {w[:SHORTEST] for w in THREATS})
        #: finds whether a text can match at all
        self.may_match = re.compile(r"(?<![^\W\d_])(?:" + "|".join(map(re.escape, first)) + ")").search

    def __call__(self, word: str) -> tuple[int, float]:
        ended = word + END
        for n in self.lengths:
            if (weight := self.stems.get(ended[:n])) is not None:
                return INSULT, weight
        return self.closed.get(word, (0, 0.0))


def clause_weight(classes: list[tuple[int, float]]) -> float:
    """The second transducer: state is (target near, negated, reported); output adds up."""
    total, target, negated, reported = 0.0, 0, 0, False
    for i, (kind, weight) in enumerate(classes):
        if kind == TARGET:
            target = 4
        elif kind == NEGATION:
            negated = 4
        elif kind == REPORT:
            reported = True
        elif kind in (INSULT, THREAT):
            beside = target or any(k == TARGET for k, _ in classes[i + 1 : i + 3])
            if kind == THREAT and not beside:
                continue  # a threat needs someone it is aimed at
            total += weight * (BESIDE_TARGET if beside else 1) * (NEGATED if negated else 1) * (REPORTED if reported else 1)
        target, negated = max(target - 1, 0), max(negated - 1, 0)
    return total


def text_weight(text: str, transduce: WordTransducer) -> tuple[float, int]:
    """Sum over the clauses that match, and how many do."""
    text = text.lower()
    if not transduce.may_match(text):
        return 0.0, 0
    weights = [clause_weight(list(map(transduce, _WORDS.findall(c)))) for c in _CLAUSES.split(text)]
    return sum(weights), sum(w > 0 for w in weights)


def score_of(weight: float) -> float:
    return 1 / (1 + math.exp(-min(50.0, SLOPE * weight + LEVEL)))


def held_out(id_col: str = "doc_id"):
    """Rows that no label may be learned from; never null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == HELD_OUT, F.lit(False))


def _stems_of(text: str) -> set[str]:
    words = set(_WORDS.findall(text.lower()))
    return {w + END for w in words} | {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}


def learn_stems(
    docs: DataFrame,
    labels: DataFrame,
    most_labelled: int = MOST_LABELLED,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> dict[str, float]:
    """Weights of the insult stems; at most ``MOST_STEMS`` of them."""
    usable = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    parts = [
        usable.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled)
        for label in (0, 1)
    ]
    sample = F.broadcast(parts[0].unionByName(parts[1]))  # 2 * most_labelled rows of 12 bytes at most
    named = F.coalesce(F.col(lang_col).cast("string"), F.lit("\0")).alias("lang")  # null is a language of its own
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), named)
    labelled = texts.join(sample, "doc_id").select("toxic", "text", "lang").distinct()
    labelled = written(labelled, "toxicity-labelled")

    def run(batches: Batches) -> Batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def counted() -> pa.RecordBatch:
            # a stem of no toxic text can't be taken; one without a name counts the texts
            keys = [(lang, None) for lang in sorted(set(seen[0]) | set(seen[1]))] + sorted(counts[1])
            toxic, clean = (
                [seen[i][lang] if stem is None else counts[i][lang, stem] for lang, stem in keys] for i in (1, 0)
            )
            columns = [pa.array([lang for lang, _ in keys], pa.string()), pa.array([x for _, x in keys], pa.string())]
            columns += [pa.array(toxic, pa.int64()), pa.array(clean, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "stem", "toxic", "clean"])

        for batch in batches:
            for toxic, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts[toxic].update((lang, stem) for stem in _stems_of(text or ""))
                seen[toxic][lang] += 1
                if len(counts[0]) + len(counts[1]) > _COUNTED:
                    yield counted()
                    for counter in (*counts, *seen):
                        counter.clear()
        yield counted()

    found = written(labelled.mapInArrow(run, "lang string, stem string, toxic long, clean long"), "toxicity-stems")
    sums = [F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")]
    seen_in = found.where("stem IS NULL").groupBy("lang").agg(*sums)
    total = seen_in.agg(*sums).first()
    if not total["toxic"]:
        return {}
    # A stem that was seen in clean texts alone gets no count then, so the clean ones are counted
    # again for the few stems that toxic texts make likely.
    floors = seen_in.select("lang", F.greatest(F.lit(float(LEAST_TOXIC_DOCS)), LEAST_SUPPORT * F.col("toxic")).alias("floor"))
    likely = [
        r["stem"]
        for r in found.where("stem IS NOT NULL")
        .groupBy("stem", "lang")
        .agg(*sums)
        .join(floors, "lang")
        .groupBy("stem")
        .agg(*sums, F.max(F.col("toxic") >= F.col("floor")).alias("held"))
        .where(F.col("held") & (F.col("toxic") >= F.lit(LEAST_PURITY) * (F.col("toxic") + F.col("clean"))))
        .orderBy(F.desc("toxic"), "stem")
        .limit(MOST_STEMS)
        .collect()
    ]
    wanted = frozenset(likely)

    def recount(batches: Batches) -> Batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[toxic].update(_stems_of(text or "") & wanted)
        stems = sorted(set(counts[0]) | set(counts[1]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(stems, pa.string()),
                pa.array([counts[1][s] for s in stems], pa.int64()),
                pa.array([counts[0][s] for s in stems], pa.int64()),
            ],
            names=["stem", "toxic", "clean"],
        )

    exact = labelled.mapInArrow(recount, "stem string, toxic long, clean long").groupBy("stem")
    weights: dict[str, float] = {}
    rows = exact.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect()
    for row in sorted(rows, key=lambda r: (len(r["stem"]), r["stem"])):
        stem, toxic, clean = row["stem"], row["toxic"], row["clean"]
        covered = any(stem[:n] in weights for n in range(SHORTEST, len(stem)))
        if not covered and toxic >= LEAST_PURITY * (toxic + clean):
            odds = (toxic + 0.5) / (total["toxic"] + 1) / ((clean + 0.5) / (total["clean"] + 1))
            weights[stem] = max(0.0, math.log(odds))
    return {s: w for s, w in weights.items() if w > 0}


def score(
    docs: DataFrame,
    stems: dict[str, float],
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score and verdict of every document under learned stems."""

    def make():
        transduce = WordTransducer(stems)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [text_weight(t or "", transduce) for t in batch.column(2).to_pylist()]
            scores = [score_of(weight) for weight, _ in found]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()),
                    pa.array([n for _, n in found], pa.int32()),
                ],
                names=[f.split()[0] for f in SCORES.split(", ")],
            )

        return work

    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        held_out(id_col).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    return arrow_map(chosen, make, SCORES)


def without_toxic(
    docs: DataFrame, stems: dict[str, float], threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, all columns as they are."""

    def run(batches: Batches) -> Batches:
        transduce = WordTransducer(stems)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            keep = [score_of(text_weight(t or "", transduce)[0]) < threshold for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
