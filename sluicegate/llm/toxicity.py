"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the classes of a clause's words: insult, threat, target,
negation and reported speech.  Their composition is one machine whose state says what has
been read so far; it emits what a clause amounts to, such as a negated insult or a threat
at somebody.  A text's score weighs the clauses it matched and not words on their own.

Insults are learned from labelled rows: stems that occur in toxic texts and hardly
elsewhere, counted once for texts that are near copies of each other.  The weights of the
machine's outputs are learned from the same rows.  Labels of held-out rows are never read.

Null and empty texts match nothing and score as such texts do.  Texts are read whole and
case-folded.  Repeated rows score alike.  Without labels the fixed words and weights hold.
An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import fresh, stored

HELD_OUT_EVERY = 5
# The bound of the labelled rows that lexicon and weights are learned from: so many toxic
# ones, and four times as many others.
TRAIN_ROWS = 4000
CLEAN_PER_TOXIC = 4
# A stem is an insult where so many different toxic texts, and such a part of them, have it,
# and where of all texts with it at least so large a part is toxic.
STEM_SUPPORT = 6
STEM_SHARE = 0.015
STEM_PURITY = 0.97
STEM_LENGTHS = range(4, 13)
# A longer stem replaces a shorter one that keeps this part of its texts.
STEM_KEEPS = 0.9
STEMS = 2000

# Words of the grammar in English, German, French and Spanish.
INSULTS = """idiot moron stupid scum loser worthless pathetic disgusting trash garbage imbecile
    dumbass idiotin trottel dummkopf abschaum arschloch imbécile crétin abruti connard salaud
    idiota imbécil estúpido basura escoria gilipollas""".split()
THREATS = """kill murder stab strangle shoot töten ermorden umbringen erschießen tuer
    assassiner égorger matar asesinar apuñalar""".split()
TARGETS = """you your he she they them him her these those du dich ihr euch sie ihn tu toi vous ils
    elles lui tú te usted ustedes ellos ellas""".split()
NEGATIONS = "not never no nor isn't aren't don't nicht kein keine nie pas jamais aucun nunca jamás".split()
REPORTS = """said says wrote quoted called reported according sagte sagt schrieb laut zitierte dit
    écrit selon rapporte dijo dice escribió según""".split()

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.!?;\n]")

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)


@dataclass(frozen=True)
class Transducer:
    """``moves[state, symbol]`` is the next state and what it adds to the output; others stay.

    ``fades`` is the number of words after which the machine is back in state 0.
    """

    name: str
    moves: dict[tuple[int, int], tuple[int, str]]
    fades: int | None = None


GRAMMAR = (
    Transducer("insult", {(0, INSULT): (1, "insult"), (1, INSULT): (1, "insult")}),
    Transducer("threat", {(0, THREAT): (1, "threat"), (1, THREAT): (1, "threat")}),
    Transducer("target", {(0, TARGET): (1, ""), (1, INSULT): (1, "targeted"), (1, THREAT): (1, "targeted")}, 8),
    Transducer("negation", {(0, NEGATION): (1, ""), (1, INSULT): (0, "negated"), (1, THREAT): (0, "negated")}, 3),
    Transducer("report", {(0, REPORT): (1, ""), (1, INSULT): (1, "reported"), (1, THREAT): (1, "reported")}),
)


@lru_cache(maxsize=1 << 16)
def _step(state: tuple[tuple[int, int], ...], symbol: int) -> tuple[tuple[tuple[int, int], ...], str]:
    """One move of the composed machine: every part reads the symbol, outputs are joined."""
    after, output = [], []
    for machine, (at, age) in zip(GRAMMAR, state, strict=True):
        if machine.fades is not None and age >= machine.fades:
            at = 0
        to, said = machine.moves.get((at, symbol), (at, ""))
        changed = (at, symbol) in machine.moves
        after.append((to, 0 if changed or not to or machine.fades is None else age + 1))
        if said:
            output.append(said)
    return tuple(after), " ".join(output)


def read_clause(symbols: list[int]) -> list[str]:
    """Outputs of the composed machine over the word classes of one clause."""
    state, found = ((0, 0),) * len(GRAMMAR), []
    for symbol in symbols:
        state, output = _step(state, symbol)
        if symbol in (INSULT, THREAT):
            found.append(output)
    return found


def clause_kind(found: list[str]) -> str:
    """What a clause amounts to: its gravest reading, affirmed and aimed before negated or reported."""
    return min(found, key=lambda o: ("negated" in o, "reported" in o, "threat" not in o, "targeted" not in o, o))


# Weights of the kinds of clause before anything has been learned.
PRIOR_WEIGHT = {"insult": 2.0, "threat": 2.5, "targeted": 0.5, "negated": -1.5, "reported": -1.0}
PRIOR_BIAS = -3.0


@dataclass
class Model:
    """Words of the insult class (whole ones, and stems that start a word) and weights."""

    words: frozenset[str] = frozenset(INSULTS)
    stems: tuple[str, ...] = ()
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = PRIOR_BIAS

    def weight(self, kind: str) -> float:
        if kind in self.weights:
            return self.weights[kind]
        return sum(PRIOR_WEIGHT[part] for part in kind.split())


class Reader:
    """Finds the clauses of a text that hold an insult or threat, and what they amount to."""

    def __init__(self, model: Model) -> None:
        self.words, self.stems = model.words, tuple(sorted(model.stems))
        self.classes = {w: c for c, ws in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS)) for w in ws}
        self.classes |= dict.fromkeys(THREATS, THREAT)
        self.anchors = ahocorasick.Automaton()
        for anchor in {*self.words, *self.stems, *THREATS}:
            self.anchors.add_word(anchor, len(anchor))
        self.anchors.make_automaton()

    def symbol(self, word: str) -> int:
        if word in self.words or word.startswith(self.stems):
            return INSULT
        return self.classes.get(word, OTHER)

    def insults(self, text: str) -> set[str]:
        """The words and stems of the insult class that the text has."""
        found = set()
        for word in set(_WORD.findall(text.lower())):
            if word in self.words:
                found.add(word)
            elif word.startswith(self.stems):
                found.update(s for s in self.stems if word.startswith(s))
        return found

    def kinds(self, text: str) -> Counter[str]:
        """How many clauses of each kind the text has; only matched clauses are read."""
        found: Counter[str] = Counter()
        text, done = text.lower(), 0
        stops: list[int] | None = None
        for end, size in self.anchors.iter(text):
            start = end - size + 1
            if start < done or (start and text[start - 1].isalpha()):
                continue
            if stops is None:
                stops = [m.start() for m in _CLAUSE_END.finditer(text)]
            before, behind = bisect.bisect_left(stops, start), bisect.bisect_right(stops, end)
            begin = max(done, stops[before - 1] + 1 if before else 0)
            until = stops[behind] if behind < len(stops) else len(text)
            outputs = read_clause([self.symbol(w) for w in _WORD.findall(text, begin, until)])
            if outputs:
                found[clause_kind(outputs)] += 1
            done = until
        return found


def score(model: Model, kinds: Counter[str]) -> float:
    """Probability of label 1 from the matched clauses; repeats count less and less."""
    total = model.bias + sum(model.weight(kind) * np.log2(1 + n) for kind, n in kinds.items())
    return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def is_held_out(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id's text is a multiple of five; rows without an id are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_EVERY == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic, early) of a bounded number of labelled rows, picked by a hash of the id.

    ``early`` marks about ``rows`` of either label.  Nothing is sorted; reruns pick the same.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~is_held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    part = {label: (rows << 30) // max(1, n) for label, n in sizes.items()}
    early = F.when(F.col("toxic") == 1, place <= part.get(1, 0)).otherwise(place <= part.get(0, 0))
    wanted = early | ((F.col("toxic") == 0) & (place <= CLEAN_PER_TOXIC * part.get(0, 0)))
    # About five times ``rows`` ids, whatever the size of the corpus.
    picked = F.broadcast(stored(known.filter(wanted).withColumn("early", early), "picked"))
    return docs.select("doc_id", F.col("text").cast("string")).join(picked, "doc_id").drop("doc_id")


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stems and whole words (marked =) of each text, with a key that near copies share."""
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = _WORD.findall((text or "").lower())
            if not words:
                continue
            runs = (hash_text(" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4)))
            stems = {w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n} | {"=" + w for w in words if len(w) > 3}
            yield pa.RecordBatch.from_pydict(
                {
                    "stem": pa.array(list(stems), pa.string()),
                    "near": pa.array([min(runs)] * len(stems), pa.int64()),
                    "toxic": pa.array([toxic] * len(stems), pa.int32()),
                }
            )


def hash_text(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def stem_counts(rows: DataFrame) -> list[tuple[str, int]]:
    """Stems that pass support, share and purity, the most frequent first; at most ``STEMS``."""
    seen = rows.filter("early").select("text", "toxic").mapInArrow(_evidence, "stem string, near bigint, toxic int")
    # Once per stem and group of near copies.
    once = seen.groupBy("stem", "near").agg(F.max("toxic").alias("toxic"))
    counted = once.groupBy("stem").agg(F.sum("toxic").alias("hits"), F.count("*").alias("n"))
    enough = max(STEM_SUPPORT, STEM_SHARE * rows.filter("toxic = 1").count())
    passed = counted.filter((F.col("hits") >= enough) & (F.col("hits") >= STEM_PURITY * F.col("n")))
    return [(r.stem, r.hits) for r in passed.orderBy(F.desc("hits"), "stem").limit(STEMS).collect()]


def confirmed(words: frozenset[str], stems: tuple[str, ...], rows: DataFrame) -> Model:
    """Only the words and stems that stay pure over all training rows."""
    reader = Reader(Model(words, stems))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = sorted(reader.insults(text or ""))
                yield pa.RecordBatch.from_pydict(
                    {"stem": pa.array(found, pa.string()), "toxic": pa.array([toxic] * len(found), pa.int32())}
                )

    counted = rows.select("text", "toxic").mapInArrow(hits, "stem string, toxic int").groupBy("stem")
    pure = counted.agg(F.avg("toxic").alias("purity")).filter(F.col("purity") >= STEM_PURITY)
    kept = {r.stem for r in pure.collect()}
    return Model(frozenset({*INSULTS, *(words & kept)}), tuple(s for s in stems if s in kept))


def insult_class(counts: list[tuple[str, int]]) -> tuple[frozenset[str], tuple[str, ...]]:
    """Whole words and stems from counted stems.

    A stem is stretched while its commonest continuation keeps nearly all its texts.  Where
    nearly all of them have it as a whole word it is a word, else it starts words.
    """
    hits = dict(counts)
    longer: dict[str, str] = {}
    for stem in hits:
        parent = stem[:-1]
        if not stem.startswith("=") and parent in hits and hits[stem] >= STEM_KEEPS * hits[parent]:
            if hits[stem] > hits.get(longer.get(parent, ""), 0):
                longer[parent] = stem
    words, stems = set(), set()
    for stem in sorted((s for s in hits if not s.startswith("=")), key=len):
        if stem in longer or any(stem.startswith(s) for s in stems):
            continue
        if hits.get("=" + stem, 0) >= STEM_KEEPS * hits[stem]:
            words.add(stem)
        elif stem[:-1] not in hits or stem[:-1] in longer:
            stems.add(stem)
    words |= {s[1:] for s in hits if s.startswith("=")}
    return frozenset(w for w in words if not w.startswith(tuple(stems))), tuple(sorted(stems))


def fit(rows: DataFrame) -> Model:
    """A model from labelled rows (text, toxic); their number is bounded by the caller."""
    counts = stem_counts(rows)
    words, stems = insult_class(counts)
    model = confirmed(words, stems, rows)

    def clauses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            found = [reader.kinds(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(["|".join(f"{k}:{n}" for k, n in sorted(c.items())) for c in found], pa.string()), batch.column(1)],
                names=["kinds", "toxic"],
            )

    # One row per different combination of clauses.
    table = rows.select("text", "toxic").mapInArrow(clauses, "kinds string, toxic int")
    cases = [(r.kinds, r.toxic, r.n) for r in table.groupBy("kinds", "toxic").agg(F.count("*").alias("n")).collect()]
    return _weighed(model, cases)


def _weighed(model: Model, cases: list[tuple[str, int, int]]) -> Model:
    """Weights by logistic regression, drawn towards the prior ones."""
    if len({toxic for _, toxic, _ in cases}) < 2:
        return model
    bags = [dict((k, int(n)) for k, n in (p.split(":") for p in text.split("|") if p)) for text, _, _ in cases]
    kinds = sorted({k for bag in bags for k in bag})
    x = np.array([[1.0, *(np.log2(1 + bag.get(k, 0)) for k in kinds)] for bag in bags])
    y, n = np.array([t for _, t, _ in cases], float), np.array([c for _, _, c in cases], float)
    prior = np.array([PRIOR_BIAS, *(model.weight(k) for k in kinds)])
    w, pull = prior.copy(), np.full(len(prior), 0.5)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + pull * (w - prior)
        curve = (x.T * (n * p * (1 - p))) @ x + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return Model(model.words, model.stems, dict(zip(kinds, w[1:].tolist(), strict=True)), float(w[0]))


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    return fit(stored(training_rows(docs, labels, rows), "labelled"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``score``: one pass, nothing is shuffled."""
    name = fresh(docs, "score")
    at, names = docs.columns.index("text"), [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            scores = [score(model, reader.kinds(t or "")) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=names)

    layout = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{layout}, `{name}` double")


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    model = trained(docs, labels, rows)
    found = scored(docs.select("doc_id", F.col("text").cast("string")), model)
    return found.select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows that score below one half, with their own columns."""
    model = trained(docs, labels, rows)
    name = fresh(docs, "score")
    return scored(docs, model).filter(F.col(name) < 0.5).drop(name)
