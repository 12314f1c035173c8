"""Language identification by string kernels: blended-spectrum presence kernels, Nyström landmarks, one-versus-rest kernel ridge regression.

A text is lower-cased; letters keep apart from each other, every run of other characters is one gap. Two texts' kernel is the number of distinct
letter sequences of 1 to ``ORDER`` signs that both have, divided by the geometric mean of their own numbers. Landmarks are
labelled texts; a text's features are its kernels with the landmarks times the inverse root of the landmarks' own kernel matrix, on
which a ridge regression for each language is fitted. Scoring multiplies batches of presence matrices with the
landmarks' presence matrix, and the kernels with the fitted weights.

The best of k languages always scores at least 1 / k, so a score can't tell that a text is of none of them. That is told by the cover: the share
of the text's distinct sequences that a language's landmarks have. A text whose cover is below the bound of every language is of none of them: it gets its best language like
any other, but is told apart (``known``), and ``identified`` rejects it. A language's bound lies half way between the cover of all but the lowest hundredth of its own fitted rows (a landmark's by the other
landmarks) and the median cover of the other languages' rows. The
longer a text, the more rare sequences it has: a long one below the bounds is of none only if most of its pieces of ``PIECE_CHARS`` are, too.

Fitting takes at most ``fit_rows`` labelled rows a language, none longer than ``fit_chars`` characters, picked by a hash of doc_id; the driver
fits, the executors score every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from packloom.ship import ship

FIT_ROWS = 300
FIT_CHARS = 20_000
LANDMARKS = 32
ORDER = 3
RIDGE = 0.05
UNKNOWN = "und"
SLAB_CHARS = 1 << 18
PIECE_CHARS = 2000


def letter_table(letters: str) -> np.ndarray:
    """For each code point: 0 for a gap, the place of a known letter from 1 on, or the number of letters and 1 for other letters."""
    place = {c: i + 1 for i, c in enumerate(letters)}
    table = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = place.get(low if len(low) == 1 else c, len(letters) + 1)
    return table


def spectra(texts: list[str], table: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Of 64 texts or fewer, the distinct sequences of all texts in order of (text, code), and their texts. A code tells a sequence of up to ORDER signs from all others."""
    points = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    lens = np.array([len(t) for t in texts], np.int64)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), lens + 1)[: len(points)]
    sign = table[points]
    stay = np.ones(len(sign), bool)
    stay[1:] = (sign[1:] > 0) | (sign[:-1] > 0) | (row[1:] != row[:-1])
    sign, row = sign[stay], row[stay]
    top = (ORDER + 1) * base**ORDER
    kind = np.uint32 if top * len(texts) < 2**32 else np.uint64
    slabs = [np.zeros(0, kind)]
    for a in range(0, len(sign), SLAB_CHARS):  # sequences that begin in one slab
        parts, code = [], np.uint64(0)
        for n in range(1, ORDER + 1):
            b = min(a + SLAB_CHARS, len(sign) - n + 1)
            if b <= a:
                break
            code = (code if n == 1 else code[: b - a]) * np.uint64(base) + sign[a + n - 1 : b + n - 1]
            ok = row[a:b] == row[a + n - 1 : b + n - 1]
            parts.append((row[a:b][ok].astype(np.uint64) * np.uint64(top) + np.uint64(n * base**ORDER) + code[ok]).astype(kind))
        slabs.append(_distinct(np.concatenate(parts)))
    every = (_distinct(np.concatenate(slabs)) if len(slabs) > 2 else slabs[-1]).astype(np.uint64)
    return every % np.uint64(top), (every // np.uint64(top)).astype(np.int64)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


@dataclass
class Model:
    langs: list[str]
    letters: str
    codes: np.ndarray  # sorted codes of the landmarks' sequences
    presence: np.ndarray  # of each code (row) in each landmark, divided by the root of the landmark's number
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray
    held: np.ndarray  # of each code (row), 1 where a landmark of the language has it
    bounds: np.ndarray  # of each language, the cover that its texts reach

    @property
    def base(self) -> int:
        return len(self.letters) + 2

    def grid(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which landmark sequences (columns) each text has, and the number of its own."""
        code, row = spectra(texts, table, self.base)
        own = np.bincount(row, minlength=len(texts))
        at = np.minimum(np.searchsorted(self.codes, code), max(0, len(self.codes) - 1))
        hit = self.codes[at] == code if len(self.codes) else np.zeros(len(code), bool)
        grid = np.zeros((len(texts), len(self.codes)), np.float32)
        grid[row[hit], at[hit]] = 1
        return grid, np.maximum(own, 1)[:, None]

    def kernels(self, texts: list[str], table: np.ndarray) -> np.ndarray:
        grid, own = self.grid(texts, table)
        return (grid @ self.presence) / np.sqrt(own)

    def score(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The languages' outputs, and whether a text is of any of them."""
        grid, own = self.grid(texts, table)
        return (grid @ self.presence) / np.sqrt(own) @ self.weights + self.bias, ((grid @ self.held) / own >= self.bounds).any(1)


def fit(rows: list[tuple[str, str]]) -> Model | None:
    """The model of (text, lang) rows; None without any."""
    rows = [(t, lang) for t, lang in rows if any(c.isalpha() for c in t)]
    if not rows:
        return None
    langs = sorted({lang for _, lang in rows})
    marks = [t for lang in langs for t in [t for t, x in rows if x == lang][:LANDMARKS]]
    letters = {c for t in marks for c in t.lower() if c.isalpha()}
    letters = "".join(sorted(letters))
    table = letter_table(letters)
    model = Model(langs, letters, np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0), np.float32), np.zeros(0))
    found = [spectra(marks[a : a + 64], table, model.base) for a in range(0, len(marks), 64)]
    code, row = (np.concatenate(x) for x in zip(*((c, r + 64 * i) for i, (c, r) in enumerate(found))))
    model.codes = np.unique(code)
    model.presence = np.zeros((len(model.codes), len(marks)), np.float32)
    model.presence[np.searchsorted(model.codes, code), row] = 1
    mark_lang = np.array([k for k, lang in enumerate(langs) for _ in [t for t, x in rows if x == lang][:LANDMARKS]])
    holders = np.stack([(model.presence[:, mark_lang == k] > 0).sum(1) for k in range(len(langs))], 1)
    model.held = (holders > 0).astype(np.float32)
    model.presence /= np.sqrt(np.maximum(np.bincount(row, minlength=len(marks)), 1)).astype(np.float32)
    own = np.concatenate([model.kernels(marks[a : a + 64], table) for a in range(0, len(marks), 64)])
    value, vector = np.linalg.eigh((own + own.T) / 2)
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    x = np.concatenate([model.kernels([t for t, _ in rows[a : a + 64]], table) for a in range(0, len(rows), 64)]) @ root
    y = np.array([[1.0 if lang == x else -1.0 for x in langs] for _, lang in rows])
    mean_x, mean_y = x.mean(0), y.mean(0)
    x = x - mean_x
    beta = np.linalg.solve(x.T @ x + RIDGE * np.eye(x.shape[1]), x.T @ (y - mean_y))
    model.weights, model.bias = (root @ beta).astype(np.float32), mean_y - mean_x @ beta
    model.bounds = cover_bounds(model, rows, holders, table)
    return model


def cover_bounds(model: Model, rows: list[tuple[str, str]], holders: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Each language's bound on the cover; ``holders`` counts the landmarks of each language (column) that have a code. One row alone binds nothing."""
    lang = np.array([model.langs.index(x) for _, x in rows])
    twice, cover, used = (holders > 1).astype(np.float32), np.zeros((len(rows), len(model.langs))), [0] * len(model.langs)
    for a in range(0, len(rows), 64):
        grid, own = model.grid([t for t, _ in rows[a : a + 64]], table)
        cover[a : a + 64], others = (grid @ model.held) / own, (grid @ twice) / own
        for i, k in enumerate(lang[a : a + 64].tolist()):
            if used[k] < LANDMARKS:  # a landmark
                cover[a + i, k] = others[i, k]
                used[k] += 1
    bounds = []
    for k in range(len(model.langs)):
        mine, rest = np.quantile(cover[lang == k, k], 0.01), cover[lang != k, k]
        bounds.append(min(mine, (mine + (np.median(rest) if len(rest) else 0)) / 2))
    return np.array(bounds)


def held_out(doc_id=None):
    return F.coalesce(F.crc32(F.col(doc_id or "doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_rows(docs: DataFrame, rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> list[tuple[str, str]]:
    """The bounded labelled sample: of each language, the rows with the smallest hashes among those not held out."""
    ship(docs.sparkSession)
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return []
    # Only hashes small enough to be among the picked ones (three times as many, so that long texts may fall out) are ranked.
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 3 * rows / n))]), F.col("lang"))
    h = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(7)), 1)
    small = known.withColumn("h", h).where(F.col("h") <= share * float(2**63)).where(F.length("text") <= chars).select("doc_id", "lang", "h")
    picked = small.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("k") <= rows).select("doc_id", "lang", "h").distinct()
    texts = docs.select("doc_id", "lang", "text").where(F.length("text") <= chars).join(F.broadcast(picked), ["doc_id", "lang"])  # rows x languages at most
    return [(r.text, r.lang) for r in texts.select("h", "doc_id", "lang", "text").orderBy("h", "doc_id", "text").collect()]


_tables: dict[str, np.ndarray] = {}


def _predict(m: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages and scores of whole texts, in slabs of bounded size, and whether they are of any learned language."""
    if m is not None and m.letters not in _tables:
        _tables[m.letters] = letter_table(m.letters)
    pred, score, sure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    todo, size = [], 0
    for i in range(len(texts) + 1):
        if todo and (i == len(texts) or size > SLAB_CHARS or len(todo) == 64):
            got, known = m.score([texts[k] for k in todo], _tables[m.letters])
            for j in [j for j, k in enumerate(todo) if not known[j] and len(texts[k]) > PIECE_CHARS]:
                text = texts[todo[j]]
                pieces = [text[a : a + PIECE_CHARS] for a in range(0, len(text), PIECE_CHARS)]
                known[j] = 2 * sum(int(m.score(pieces[a : a + 64], _tables[m.letters])[1].sum()) for a in range(0, len(pieces), 64)) >= len(pieces)
            best = got.argmax(1)
            score[todo], sure[todo] = np.clip((got[np.arange(len(todo)), best] + 1) / 2, 0, 1), known
            for k, b in zip(todo, best.tolist()):
                pred[k] = m.langs[b]
            todo, size = [], 0
        if i < len(texts) and m is not None and texts[i] and any(map(str.isalpha, texts[i])):
            todo.append(i)
            size += len(texts[i])
    return pred, score, sure


def identified(docs: DataFrame, min_score: float, rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> DataFrame:
    """``docs`` without those that are ``und``, of none of the learned languages, or score less than ``min_score``; all columns stay as they are. ``rows`` and ``chars`` bound the sample that the model is fitted on."""
    model = docs.sparkSession.sparkContext.broadcast(fit(fit_rows(docs, rows, chars)))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, score, sure = _predict(model.value, batch.column("text").to_pylist())
            yield batch.filter(pa.array(sure & (score >= min_score)))

    return docs.mapInArrow(keep, docs.schema)


def identify(docs: DataFrame, rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1) and known of every row. ``rows`` (a language) and ``chars`` bound the sample that the model is fitted on.

    Null texts, texts without letters, and all texts where nothing can be learned, are ``und`` with score 0; any other text has a learned language, ``known`` tells whether it looks like a text of one. Null doc_ids are not held
    out and not learned from. Of languages that score alike the first by name is taken. A very long text is read whole, some 20 bytes of memory a character. Repeated rows are
    predicted alike; an empty table gives no rows; other columns don't matter.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(fit_rows(docs, rows, chars)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score, sure = _predict(model.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score), pa.array(sure)], names=["doc_id", "held_out", "lang_pred", "score", "known"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double, known boolean")
