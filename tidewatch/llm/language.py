"""Language identification by cross-parsing entropy.

For each language a suffix automaton recognises every substring of a bounded sample of labelled text.  A text is
parsed from left to right into the longest phrases that occur in the sample; the better the sample predicts the
text, the fewer phrases.  Phrases times the bits of a pointer into the sample, over the length, is the entropy
estimate, and the language with the least wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._text import pieces, utf8

#: Symbols of the sample of a language; an automaton has fewer than two states for each, which fits 15 bits.
SAMPLE_SYMBOLS = 16_000
#: Labelled documents drawn for each language, and symbols taken from each.
SAMPLE_DOCS, SAMPLE_EACH = 96, 400
#: Bytes of the automata of all languages, which are broadcast: with more than 32 languages samples are shorter.  Languages
#: at most, so that each has a sample of 500 symbols.
TABLE_BYTES, MOST_LANGUAGES = 256 << 20, 1_000
#: Blocks of this many symbols of a text are parsed side by side, and then joined as if one after the other.
BLOCK = 1024
#: Symbols that are looked at at once when a block is read again.
AHEAD = 48
#: Bytes of text whose blocks advance together: many, as each step of all of them is one call.
TOGETHER = 4 << 20

#: Symbol of each byte: a letter without its case, 0 for all other ASCII, six bits of the second and later bytes of a
#: character in UTF-8, five of the first.
SYMBOL = np.zeros(256, np.uint8)
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[128:192], SYMBOL[192:] = 27 + np.arange(64), 91 + (np.arange(64) & 31)
#: Symbols that a table has a column for, as a power of two.
WIDTH = 7
_END = 1 << 15


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all rows and their offsets, with a single 0 for a run of them."""
    base = int(offsets[0])
    s = SYMBOL[data[base : int(offsets[-1])]]
    edges = offsets - base
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    keep[edges[:-1][edges[:-1] < len(s)]] = True
    kept = np.zeros(len(s) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return s[keep], kept[edges]


def automaton(sample: np.ndarray) -> np.ndarray:
    """The suffix automaton of ``sample`` as a table [state * 128 + symbol] -> state; where no phrase goes on, the state
    after the symbol begins the next phrase, marked with the high bit."""
    if len(sample) > SAMPLE_SYMBOLS:
        raise ValueError("the sample is longer than its bound")
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in sample.tolist():
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    table = np.empty((len(moves), 1 << WIDTH), np.uint16)
    table[:] = _END
    for c, to in moves[0].items():
        table[:, c] = to | _END
    for state, to in enumerate(moves):
        for c, t in to.items():
            table[state, c] = t
    return table.ravel()


def phrases(s: np.ndarray, offsets: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Phrases of each row by each automaton: [row, table].

    All blocks of all rows advance together, each from the start of a phrase.  Then a block is read again from the state
    in which the one before it ends, until it is in the state it was in the first time, from where all is the same: after
    a few phrases, in most texts.
    """
    sizes = np.diff(offsets)
    blocks = -(-sizes // BLOCK)
    row = np.repeat(np.arange(len(sizes)), blocks)
    at = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = offsets[row] + at * BLOCK
    size = np.minimum(BLOCK, offsets[row + 1] - begin)
    order = np.argsort(-size, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    later = np.flatnonzero(at > 0)
    follows = list(zip(place[later - 1].tolist(), place[later].tolist(), strict=True))  # in the order of the texts
    begin, size, row = begin[order], size[order], row[order]
    active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")
    out = np.zeros((len(sizes), len(tables)), np.int64)
    starts, lengths = begin.tolist(), size.tolist()
    for k, table in enumerate(tables):
        state, count = np.zeros(len(row), np.int32), np.zeros(len(row), np.int32)
        first = []  # by symbol, where each block got to
        for i, n in enumerate(active):
            step = table[(state[:n] << WIDTH) | s[begin[:n] + i]]
            first.append(step)
            step = step.astype(np.int32)
            count[:n] += step >> 15
            state[:n] = step & (_END - 1)
        moves, ends = memoryview(table), state.tolist()
        for a, b in follows:
            now, more = ends[a], 0
            for i in range(0, lengths[b], AHEAD):
                there = min(AHEAD, lengths[b] - i)
                for j, c in enumerate(s[starts[b] + i : starts[b] + i + there].tolist(), i):
                    to, was = moves[now << WIDTH | c], int(first[j][b])
                    more += (to >> 15) - (was >> 15)
                    now = to & (_END - 1)
                    if now == was & (_END - 1):
                        break
                else:
                    continue
                break
            else:
                ends[b] = now
            count[b] += more
        np.add.at(out[:, k], row, count)
    return out + 1


def fit(labelled: DataFrame) -> list[tuple[str, np.ndarray, float]]:
    """(language, automaton, bits of a phrase) from ``labelled(doc_id, text, lang)``, sorted by language.

    The sample is bounded: of each language the ``SAMPLE_DOCS`` documents of the smallest hash of doc_id and text, and of
    each of them equal shares of ``SAMPLE_SYMBOLS``, of which short ones leave the rest to others, but ``SAMPLE_EACH`` at
    most.  What is taken of a text begins at a place that its hash tells, anywhere in the text.  Rows without text or
    language are ignored, those without doc_id aren't; no rows give no languages, more than ``MOST_LANGUAGES`` of them
    raise ValueError.
    """
    rows = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    rows = rows.select("lang", "text", F.xxhash64(F.lit("sample"), "doc_id", "text").alias("h"))
    if rows.agg(F.approx_count_distinct("lang", 0.02)).first()[0] > MOST_LANGUAGES:
        raise ValueError(f"more than about {MOST_LANGUAGES} languages")
    order = Window.partitionBy("lang").orderBy("h")
    drawn = rows.select("h", "lang").withColumn("i", F.row_number().over(order)).where(F.col("i") <= SAMPLE_DOCS).collect()
    most = 4 * SAMPLE_EACH
    begin = F.pmod(F.xxhash64(F.lit("begin"), "h"), F.greatest(F.lit(1), F.length("text") - most + 1)) + 1
    stretch = F.substring(F.col("text"), begin.cast("int"), F.lit(most))
    chosen = rows.where(F.col("h").isin(sorted({x.h for x in drawn}))).select("h", "lang", stretch.alias("text")).distinct()  # repeated rows once
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in chosen.collect():
        texts.setdefault(r.lang, []).append((r.h, r.text))
    models = []
    symbols_each = min(SAMPLE_SYMBOLS, TABLE_BYTES // (4 << WIDTH) // max(1, len(texts)))
    for lang in sorted(texts):
        drawn_texts, parts, left = [], [], symbols_each
        for _, text in sorted(texts[lang])[:SAMPLE_DOCS]:
            data = np.frombuffer(text.encode(), np.uint8)
            drawn_texts.append(symbols(data, np.array([0, len(data)]))[0][:SAMPLE_EACH])
        for i, s in enumerate(sorted(drawn_texts, key=len)):
            parts += [s[: left // (len(drawn_texts) - i) - 1], np.zeros(1, np.uint8)]
            left -= len(parts[-2]) + 1
        sample = np.concatenate(parts)
        models.append((lang, automaton(sample), float(np.log2(len(sample) + 1))))
    return models


def predict(docs: DataFrame, models: list[tuple[str, np.ndarray, float]]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share by which the best language's entropy is under the next one's.

    A text that is null, empty or without a letter is ``und`` with score 0, as is every text if there are no models;
    of languages with equal entropy the first by name wins.  Whole texts are parsed; other columns pass through, and
    columns of those two names are replaced.
    """
    names, bits = [m[0] for m in models], np.array([m[2] for m in models])
    shared = docs.sparkSession.sparkContext.broadcast([m[1] for m in models])
    docs = docs.drop("lang_pred", "score", "_letters").withColumn("_letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = T.StructType(list(docs.drop("_letters").schema)).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            best, score = np.full(len(batch), -1), np.zeros(len(batch))
            for a, b in pieces(offsets, TOGETHER) if names else ():
                s, edges = symbols(data, offsets[a : b + 1])
                cost = phrases(s, edges, shared.value) * bits / np.maximum(1, np.diff(edges))[:, None]
                best[a:b] = cost.argmin(1)
                low = np.sort(cost, 1)
                score[a:b] = 1 - low[:, 0] / np.maximum(low[:, 1], 1e-9) if len(names) > 1 else 1.0
            known = batch.column("_letters").to_numpy(zero_copy_only=False) & (best >= 0)
            lang = [names[i] if k else "und" for i, k in zip(best.tolist(), known.tolist(), strict=True)]
            columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "_letters"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(np.where(known, score, 0.0))], names=schema.names)

    return docs.mapInArrow(run, schema)


def language_id(docs: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``; learned from the documents that are not held out.

    A document is held out if crc32 of its doc_id as text is divisible by 5; one without doc_id is not.
    """
    docs = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)))
    return predict(docs, fit(docs.where(~F.col("held_out"))))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    models = fit(docs.where(~held))
    return predict(docs.select("doc_id", "text", held.alias("held_out")), models).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op6_language_id": op6_language_id}
