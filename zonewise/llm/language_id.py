"""Language identification with error-correcting output codes.

Every language has a codeword.  One binary classifier for each bit, on hashed byte n-grams of the whole
text, predicts that bit; a text gets the language whose codeword costs least, the bits weighted by how
well each did for that language on the learning rows (loss-weighted decoding).  If the two cheapest
languages lie close together the text is flagged as ambiguous.

Learning uses at most about ``SAMPLE_ROWS`` labelled rows, the same number for each language as far as
there are; rows are chosen by a hash of their id.  Only the text is an input of a prediction.

A null text or one without a letter is ``und`` with score 0.  With no learned language all are ``und``;
with one learned language every text with a letter gets it, with score 1.  Rows with a null label are not
learned from.  Added columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm.common import field, map_rows
from zonewise.llm.ngrams import byte_ngrams, fit_bits

SAMPLE_ROWS = 3000
FEATURES = 4096
AMBIGUOUS = 0.05
UNDETERMINED = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # language x bit, -1 or 1
    trust: np.ndarray  # language x bit, each row sums to 1
    weights: np.ndarray
    offset: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Cost of each codeword for each row of features."""
        margins = (x @ self.weights + self.offset)[:, None, :] * self.codes[None]
        return (np.logaddexp(0, -margins) * self.trust[None]).sum(axis=2)

    def shares(self, x: np.ndarray) -> np.ndarray:
        losses = self.losses(x) * self.codes.shape[1]
        e = np.exp(losses.min(axis=1, keepdims=True) - losses)
        return e / e.sum(axis=1, keepdims=True)


def codewords(count: int, seed: int = 7) -> np.ndarray:
    """``count`` codewords far apart: all splits for few languages, else the best of several random codes."""
    if count < 2:
        return np.ones((count, 1), np.float32)
    if count <= 6:
        splits = [[1 if (s >> i) & 1 else -1 for i in range(count - 1)] + [1] for s in range(2 ** (count - 1) - 1)]
        return np.array(splits, np.float32).T
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(count)))
    best, far = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.float32), (count, bits))
        code = code[:, np.abs(code.sum(axis=0)) < count]
        near = int(min((bits - (code[i] * code[j]).sum()) / 2 for i in range(count) for j in range(i)))
        if near > far:
            best, far = code, near
    return best


def _features(text_col: str, size: int):
    def start():
        def work(batch):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            return [[byte_ngrams(t, size).astype(np.float16).tobytes() for t in texts]]

        return work

    return start


def sample(labelled: DataFrame, lang_col: str, id_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows, evenly over the languages, chosen by a hash of the id."""
    known = labelled.filter(field(lang_col).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(field(lang_col).alias("x_lang")).count().collect()}
    if not sizes:
        return known.limit(0)
    each, steps = max(1, rows // len(sizes)), 1 << 20
    limits = F.create_map(*[F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(steps, steps * each // n + 1))])
    return known.filter(F.pmod(F.xxhash64(field(id_col)), F.lit(steps)) < F.element_at(limits, field(lang_col)))


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
) -> LanguageModel:
    chosen = sample(labelled, lang_col, id_col, rows).select(
        field(lang_col).alias("x_lang"), field(id_col).alias("x_id"), field(text_col).alias("x_text")
    )
    got = map_rows(chosen, _features("x_text", features), {"x_features": "binary"}, drop=("x_text",)).collect()
    got.sort(key=lambda r: (r["x_lang"], str(r["x_id"]), bytes(r["x_features"])))
    x = np.array([np.frombuffer(r["x_features"], np.float16) for r in got], np.float32).reshape(len(got), features)
    languages = sorted({r["x_lang"] for r in got})
    codes = codewords(len(languages))
    if len(languages) < 2:
        width = codes.shape[1] if languages else 1
        return LanguageModel(languages, codes, np.ones_like(codes), np.zeros((features, width), np.float32), np.zeros(width, np.float32))
    of = np.array([languages.index(r["x_lang"]) for r in got])
    weights, offset = fit_bits(x, codes[of])
    right = (x @ weights + offset) * codes[of] > 0
    trust = np.array([right[of == i].mean(axis=0) for i in range(len(languages))]) + 1e-3
    return LanguageModel(languages, codes, trust / trust.sum(axis=1, keepdims=True), weights, offset)


def _predict(shared, text_col: str, ambiguous: float):
    def start():
        import regex

        model, letter = shared.value, regex.compile(r"\p{L}")
        size = model.weights.shape[0]

        def work(batch):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            names, scores, flags = [], [], []
            for text in texts:
                if not model.languages or not text or not letter.search(text):
                    names.append(UNDETERMINED), scores.append(0.0), flags.append(True)
                    continue
                share = model.shares(byte_ngrams(text, size)[None])[0]
                best = int(share.argmax())
                rest = np.delete(share, best)
                names.append(model.languages[best])
                scores.append(float(share[best]))
                flags.append(bool(len(rest) and share[best] - rest.max() < ambiguous))
            return [names, scores, flags]

        return work

    return start


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", ambiguous: float = AMBIGUOUS) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_rows(
        docs, _predict(shared, text_col, ambiguous), {"lang_pred": "string", "score": "double", "ambiguous": "boolean"}
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: the checksum of the id, written as text, modulo 4 is 2."""
    return F.coalesce(F.pmod(F.crc32(field(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def recognised(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is determined and not ambiguous, columns unchanged."""
    packed = docs.select(F.struct("*").alias("x_row"), field(text_col).alias("x_text"))
    return identify(packed, model, "x_text").filter(f"lang_pred <> '{UNDETERMINED}' AND NOT ambiguous").select("x_row.*")
