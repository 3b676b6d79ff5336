"""Language identification with spans of mixed-language text.

Hashed character n-grams of words, with word borders, give each word a score in
each language. The script of a word narrows its candidates to languages written
in it. Viterbi over the words, with a penalty for each switch, labels spans.

Texts of a block are one sequence of words in which switching is free at the
first word of a text. The sequence is gone through in windows whose memory does not
depend on the number of languages. With few languages a window is cut into stretches of
equal length that are solved side by side for every entering language, chained, and
traced back; with many it is one stretch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import blocks, large_texts
from tessera.llm.scripts import NAMES, script_table

UNDETERMINED = "und"
BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
SAMPLE_PER_LANG = 3_000
SWITCH_PENALTY = 8.0
SCRIPT_SHARE = 0.01
NOT_CANDIDATE = -50.0
STRETCH = 512
# Above so many languages, trying every entering one costs more than going word by word.
SIDE_BY_SIDE = 64
WINDOW_CELLS = 8_000_000  # words x languages of a window
GATHERED_CELLS = 500_000  # words x languages scored at once

PREDICTED = (
    "doc_id bigint, lang_pred string, score double, n_words bigint, "
    "spans array<struct<lang:string,first_word:bigint,n_words:bigint,n_letters:bigint>>"
)


class LanguageModel(NamedTuple):
    langs: list[str]
    weights: np.ndarray  # buckets x languages, log probabilities
    candidates: np.ndarray  # scripts x languages


def letter_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case runs of letters of all texts in order, and how many each text has."""
    texts = pc.utf8_lower(large_texts(texts))
    # Words are cut out with a border on both sides, hence never empty in the middle.
    words = pc.split_pattern_regex(texts, r"[^\pL]+")
    flat = words.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    held = np.r_[0, np.cumsum(real)]
    return flat.filter(pa.array(real)), held[ends] - held[ends - sizes]


def word_features(words: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each n-gram length, buckets and the number of grams per word; the first letters."""
    size = np.array([len(w) for w in words], np.int64)
    chars = np.frombuffer("".join(f"\1{w}\1" for w in words).encode("utf-32-le"), np.uint32)
    padded = size + 2
    start = np.cumsum(padded) - padded
    code = chars.astype(np.uint64)
    grams = []
    for n in GRAMS:
        count = np.maximum(padded - n + 1, 0)
        at = np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)
        mixed = np.full(len(at), n, np.uint64)
        for k in range(n):
            mixed = (mixed ^ code[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        grams.append(((mixed >> np.uint64(20)).astype(np.int64) % BUCKETS, count))
    return grams, chars[start + 1]


def sampled(docs: DataFrame, per_lang: int) -> tuple[list[str], DataFrame]:
    """The languages, and about ``per_lang`` distinct labelled texts of each, by a hash of the text.

    A text that repeats in a language is one text, whatever the number of its copies.
    """
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").withColumn(
        "place", F.xxhash64("text")
    )
    counts = labelled.select("lang", "place").distinct().groupBy("lang").count().collect()
    if not counts:
        return [], labelled.select("text", "lang")
    # Hashes are spread over all 64 bits; those below a language's bound are drawn.
    bounds = {r["lang"]: (per_lang << 64) // r["count"] - (1 << 63) for r in counts}
    most = (1 << 63) - 1
    bound = F.create_map(*(F.lit(x) for k, at in bounds.items() for x in (k, min(at, most))))
    drawn = labelled.where(F.col("place") <= bound[F.col("lang")])
    return sorted(bounds), drawn.dropDuplicates(["lang", "place"]).select("text", "lang")


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = SAMPLE_PER_LANG,
) -> LanguageModel:
    """A model of the languages of labelled texts.

    It is fitted on about ``per_lang`` distinct texts of each language, drawn by a hash
    over all of them; whole texts are counted. Rows without text or language
    teach nothing, an empty table gives a model without languages. What reaches the
    driver is a table of languages x buckets, 256 KB a language; there is no most.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    langs, rows = sampled(rows, per_lang)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        script = script_table()
        total: dict[str, np.ndarray] = {}
        for block in blocks(batches, "text"):
            for lang in set(block.column("lang").to_pylist()):
                texts = block.filter(pc.equal(block.column("lang"), lang)).column("text")
                coded = letter_words(texts)[0].dictionary_encode()
                if not len(coded):
                    continue
                times = np.bincount(coded.indices.to_numpy())
                grams, first = word_features(coded.dictionary.to_pylist())
                held = total.setdefault(lang, np.zeros(BUCKETS + len(NAMES)))
                for bucket, n in grams:
                    held[:BUCKETS] += np.bincount(bucket, np.repeat(times, n), BUCKETS)
                held[BUCKETS:] += np.bincount(script[first], times, len(NAMES))
        for lang, held in total.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(held[at])],
                names=["lang", "bucket", "n"],
            )

    counted = (
        rows.mapInArrow(count, "lang string, bucket bigint, n double")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("ns"))
    )
    counts = np.zeros((BUCKETS + len(NAMES), len(langs)))
    for row in counted.toLocalIterator():
        counts[row["buckets"], langs.index(row["lang"])] = row["ns"]
    seen = counts[:BUCKETS] + 0.5
    scripts = counts[BUCKETS:]
    return LanguageModel(
        langs,
        np.log(seen / seen.sum(0)),
        scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1),
    )


def word_scores(words: list[str], model: LanguageModel, script: np.ndarray) -> np.ndarray:
    """Scores of distinct words in each language, the best 0."""
    step = max(1, GATHERED_CELLS // len(model.langs))
    scores = np.zeros((len(words), len(model.langs)))
    for at in range(0, len(words), step):
        grams, first = word_features(words[at : at + step])
        held = scores[at : at + step]
        for bucket, count in grams:
            some = count > 0
            start = (np.cumsum(count) - count)[some]
            held[some] += np.add.reduceat(model.weights[bucket], start, axis=0)
        held /= len(GRAMS)
        fits = model.candidates[script[first]]
        held[~fits] = -np.inf
        held[~fits.any(1)] = 0
        held -= held.max(1, keepdims=True)
    return np.maximum(scores, NOT_CANDIDATE)


class Trace(NamedTuple):
    """What leads back through a window: where switches pay, and from which label."""

    switched: np.ndarray  # length x stretches x labels
    source: np.ndarray  # length x stretches
    before: np.ndarray  # stretches x labels, the label that enters the stretch
    n: int


def forward(
    scores: np.ndarray, penalty: np.ndarray, entering: np.ndarray
) -> tuple[np.ndarray, Trace]:
    """The best sums that leave a window in each label, given those that enter it."""
    n, k = scores.shape
    length = n
    if k <= SIDE_BY_SIDE:
        length = max(min(STRETCH, n), -(-n * k * k // 4_000_000))
    parts = -(-n // length)
    score = np.zeros((parts * length, k))
    cost = np.full(parts * length, np.inf)  # no switches behind the end
    score[:n], cost[:n] = scores, penalty
    score = score.reshape(parts, length, k).transpose(1, 0, 2).copy()
    cost = cost.reshape(parts, length).T.copy()
    value = np.zeros((parts, k))
    value[0] = entering
    if parts > 1:
        # Best sum of each stretch from every entering to every leaving label.
        best = np.where(np.eye(k, dtype=bool), 0.0, -1e9)[None].repeat(parts, 0)
        for t in range(length):
            best = np.maximum(best, best.max(2, keepdims=True) - cost[t][:, None, None])
            best += score[t][:, None, :]
        for part in range(parts - 1):
            left = (value[part][:, None] + best[part]).max(0)
            value[part + 1] = left - left.max()
    # With what really enters, noting where switches pay.
    switched = np.zeros((length, parts, k), bool)
    source = np.zeros((length, parts), np.int64)
    for t in range(length):
        source[t] = value.argmax(1)
        other = value.max(1) - cost[t]
        switched[t] = other[:, None] > value
        value = np.where(switched[t], other[:, None], value) + score[t]
    before = np.arange(k)[None].repeat(parts, 0)
    if parts > 1:
        for t in range(length - 1, -1, -1):
            rows = np.arange(parts)[:, None]
            before = np.where(switched[t][rows, before], source[t][:, None], before)
    return value[-1], Trace(switched, source, before, n)


def backward(trace: Trace, leaving: int) -> tuple[np.ndarray, int]:
    """The labels of a window that leaves in ``leaving``, and the label that enters it."""
    length, parts, _ = trace.switched.shape
    rows = np.arange(parts)
    last = np.zeros(parts, np.int64)
    last[-1] = leaving
    for part in range(parts - 1, 0, -1):
        last[part - 1] = trace.before[part, last[part]]
    labels = np.zeros((length, parts), np.int64)
    for t in range(length - 1, -1, -1):
        labels[t] = last
        last = np.where(trace.switched[t][rows, last], trace.source[t], last)
    return labels.T.reshape(-1)[: trace.n], int(last[0])


def viterbi(
    scores: Callable[[int, int], np.ndarray], penalty: np.ndarray, n_labels: int
) -> np.ndarray:
    """Best labels of a sequence, where entering row ``i`` in another label costs ``penalty[i]``.

    ``scores(a, b)`` gives rows ``a`` to ``b``. Windows are gone through forwards for
    the sums that enter them, then backwards for their labels.
    """
    n, step = len(penalty), max(1, WINDOW_CELLS // max(1, n_labels))
    labels = np.zeros(n, np.int64)
    starts = list(range(0, n, step))
    entering = [np.zeros(n_labels)]
    trace = None
    for a in starts:
        b = min(a + step, n)
        left, trace = forward(scores(a, b), penalty[a:b], entering[-1])
        entering.append(left - left.max())
    last = int(entering[-1].argmax()) if n else 0
    for i in range(len(starts) - 1, -1, -1):
        a, b = starts[i], min(starts[i] + step, n)
        if i < len(starts) - 1:
            trace = forward(scores(a, b), penalty[a:b], entering[i])[1]
        labels[a:b], last = backward(trace, last)
    return labels


def predict(
    docs: DataFrame,
    model: LanguageModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    switch_penalty: float = SWITCH_PENALTY,
) -> DataFrame:
    """Language of every whole text, and its spans.

    The language is that of most letters (the first by name on a tie), the score
    their share. A text that is null or has no letter is ``und`` with score 0 and
    no spans, as is every text if nothing was learned. One row per input row.
    """
    # Plain values: a class would have to be importable where they are unpickled.
    known = docs.sparkSession.sparkContext.broadcast(tuple(model))
    letters_type = pa.list_(
        pa.struct(
            [("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()),
             ("n_letters", pa.int64())]
        )
    )

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, script = LanguageModel(*known.value), script_table()
        langs = model.langs
        for block in blocks(batches, "text"):
            words, sizes = letter_words(block.column("text"))
            coded = words.dictionary_encode()
            n = block.num_rows
            found, score, spans = [UNDETERMINED] * n, [0.0] * n, [[] for _ in range(n)]
            if len(words) and langs:
                number = coded.indices.to_numpy()

                def scores(a: int, b: int, number=number, known_words=coded.dictionary) -> np.ndarray:
                    held = np.zeros(len(known_words), bool)
                    held[number[a:b]] = True
                    own = known_words.filter(pa.array(held)).to_pylist()
                    return word_scores(own, model, script)[(np.cumsum(held) - 1)[number[a:b]]]

                letters = pc.utf8_length(words).to_numpy().astype(np.int64)
                begin = np.cumsum(sizes) - sizes
                penalty = np.full(len(words), switch_penalty)
                penalty[begin[sizes > 0]] = 0.0
                labels = viterbi(scores, penalty, len(langs))
                doc = np.repeat(np.arange(n), sizes)
                share = np.bincount(doc * len(langs) + labels, letters, n * len(langs))
                share = share.reshape(n, len(langs))
                best, total = share.argmax(1), share.sum(1)
                for i in np.flatnonzero(sizes).tolist():
                    found[i] = langs[best[i]]
                    score[i] = float(share[i, best[i]] / total[i])
                cut = np.r_[True, (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1])]
                cut = np.flatnonzero(cut)
                held = np.add.reduceat(letters, cut)
                size = np.diff(np.r_[cut, len(words)])
                rows = zip(
                    doc[cut].tolist(), labels[cut].tolist(), cut.tolist(), size.tolist(), held.tolist()
                )
                for i, lang, first, n_words, n_letters in rows:
                    spans[i].append(
                        {
                            "lang": langs[lang],
                            "first_word": first - int(begin[i]),
                            "n_words": n_words,
                            "n_letters": n_letters,
                        }
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(found, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(spans, letters_type),
                ],
                names=["doc_id", "lang_pred", "score", "n_words", "spans"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(label, PREDICTED)


def held_out(doc_id: Column) -> Column:
    """True for the documents that the model must not have seen; a null id is not held out."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def identify(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """Learns from the documents that are not held out and predicts all.

    One row per row of ``docs``, repeated ones included. A null doc_id is not held out
    and stays null; null and empty texts are ``und`` with score 0 and teach nothing; equal
    texts in a language are learned from once; an empty table gives an empty result.
    Columns other than doc_id, text and lang have no part in it.
    """
    model = train(docs.where(~held_out(F.col("doc_id"))), per_lang=per_lang)
    return predict(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        F.size("spans").alias("n_spans"),
    )
