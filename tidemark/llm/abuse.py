"""Abusive, hateful or sexual content: a counterfactually regularised classifier."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.words import plain

#: Labelled documents that are fitted on at most, chosen by a hash of their id.
MOST_LABELLED = 8_000
#: Longer labelled texts are not fitted on (they are scored whole like all others).
MOST_LABELLED_CHARS = 200_000
#: Hashed features.
FEATURE_BITS = 18
#: Sentences with fewer features than this get no larger weights for it.
SHORT = 40
#: Characters of distinct pieces of text that a worker remembers; beyond, it forgets all and starts anew.
KEPT_CHARS = 2_000_000
#: Sentences that are scored at once.
AT_ONCE = 20_000
# Names of groups by language; those of a line are swapped for each other in labelled sentences.
IDENTITY_TERMS = tuple(
    tuple(line.split())
    for line in """
women men girls boys gays lesbians queers transgender blacks whites asians africans europeans arabs jews muslims christians hindus atheists immigrants migrants refugees foreigners natives disabled elderly pensioners peasants minorities
female male gay lesbian queer trans straight black white brown asian african european arab jewish muslim christian hindu atheist immigrant migrant refugee foreign native deaf blind old young poor rich
Frauen Männer Mädchen Jungen Schwule Lesben Schwarze Weiße Asiaten Afrikaner Araber Juden Muslime Christen Atheisten Einwanderer Migranten Flüchtlinge Ausländer Behinderte Alte Rentner Arme Bauern
femmes hommes filles garçons gays lesbiennes noirs blancs asiatiques africains arabes juifs musulmans chrétiens athées immigrés migrants réfugiés étrangers handicapés vieux retraités pauvres paysans
mujeres hombres niñas niños gays lesbianas negros blancos asiáticos africanos árabes judíos musulmanes cristianos ateos inmigrantes migrantes refugiados extranjeros discapacitados ancianos jubilados pobres campesinos
女性 男性 少女 少年 同性愛者 黒人 白人 アジア人 アフリカ人 アラブ人 ユダヤ人 イスラム教徒 キリスト教徒 移民 難民 外国人 障害者 老人 高齢者 貧乏人 農民
""".strip().splitlines()
)
# Signs that stand for letters in disguised spelling.
SIGNS = str.maketrans("0134578@$!|+", "oieastbasilt")

_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])\s*")
_SHORTENED = tuple(f"{w}." for w in ("Co", "Inc", "Corp", "Ltd", "Mr", "Mrs", "Ms", "Dr", "vs", "No", "St"))
_MAYBE_SPACED = re.compile(r"\w[ ._\-]\w[ ._\-]\w[ ._\-]\w\b")
_SPACED = regex.compile(r"(?<![\p{L}\p{N}])(?:\p{L}[ ._\-]){3,}\p{L}(?![\p{L}\p{N}])")
_NUMBER = re.compile(r"[#$€£+\-(]*\d[\d.,:/\-]*[%kmb)]*(?:st|nd|rd|th)?")
_TICKER = re.compile(r"#?[A-Z]{2,6}(?:[.\-][A-Z])?")
_MASKED = regex.compile(r"\p{L}[*#_.\-]{2,}\p{L}?|\p{L}+\*+\p{L}*")
_EDGE = " \t\"'“”‘’«»„()[]{}<>,.;:!?…~`=/\\"
_RUN = re.compile(r"(.)\1+")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_MASK = (1 << FEATURE_BITS) - 1


def sentences(text: str | None) -> list[str]:
    """The text's sentences and lines, without markup and invisible characters."""
    out: list[str] = []
    for line in plain(text).split("\n") if text else ():
        held = ""
        for part in _SENTENCE.split(line):
            held = f"{held} {part}" if held else part
            if held.endswith(_SHORTENED) and held.rpartition(" ")[2] in _SHORTENED:
                continue
            out.append(held)
            held = ""
        out.append(held)
    return [s for s in (p.strip() for p in out) if s]


def _piece(raw: str, shouted: bool) -> list[str]:
    """The words of a piece of text between blanks."""
    out = []
    bare = raw.strip(_EDGE)
    for part in bare.split("-") if "*" not in raw else [bare]:
        if not part:
            continue
        if _NUMBER.fullmatch(part):
            out.append("<n>")
        elif part[0] == "@" and part[1:].isalnum() and any(c.isdigit() for c in part):
            out.append("<user>")
        elif not shouted and _TICKER.fullmatch(part):
            out.append("<sym>")
        else:
            word = part.lower()
            if _MASKED.fullmatch(word):
                out += ["<masked>", f"{word[0]}*{word[-1] if word[-1] != '*' else ''}"]
                continue
            if not word.isalpha() and any(c.isalpha() for c in word):
                word = word.translate(SIGNS)
            out.append(_RUN.sub(r"\1", word))
    return out


def _sign(word: str) -> str:
    """A word's first letter and its others in order, the same for swapped letters."""
    return word[0] + "".join(sorted(word[1:])) if len(word) > 3 and word[0] != "<" else word


def _code(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


def _own_features(word: str) -> list[int]:
    own = [_code("w" + word) & _MASK, _code("s" + _sign(word)) & _MASK]
    if _CJK.search(word):
        own += [_code("c" + word[i : i + n]) & _MASK for n in (2, 3) for i in range(len(word) - n + 1)]
    elif len(word) >= 5 and word[0] != "<":
        edged = f"^{word}$"
        own += [_code("c" + edged[i : i + 4]) & _MASK for i in range(len(edged) - 3)]
    return own


@dataclass
class Rows:
    """Sentences as sparse rows of features."""

    flat: np.ndarray
    sizes: np.ndarray
    scale: np.ndarray | None = None  # from the number of all features, also those left out
    starts: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1])).astype(np.int64)
        if self.scale is None:
            self.scale = 1 / np.sqrt(np.maximum(self.sizes, SHORT))

    def only(self, used: np.ndarray, columns: np.ndarray) -> Rows:
        """The rows with used features alone, renumbered."""
        kept = used[self.flat]
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)[kept]
        return Rows(columns[self.flat[kept]], np.bincount(owner, minlength=len(self.sizes)), self.scale)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        if not len(self.flat):
            return np.zeros(len(self.sizes))
        total = np.add.reduceat(np.append(weights[self.flat], 0.0), np.minimum(self.starts, len(self.flat)))
        return np.where(self.sizes > 0, total, 0.0) * self.scale

    def back(self, values: np.ndarray, columns: int) -> np.ndarray:
        return np.bincount(self.flat, np.repeat(values * self.scale, self.sizes), minlength=columns)


class Vocabulary:
    """Pieces of text as words and words as hashed features, each worked out once.

    Disguises are undone; numbers, users and tickers are classes. A sentence is
    a list of word numbers, many sentences become ``Rows`` in a few numpy steps.
    """

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.pieces: tuple[dict[str, list[int]], dict[str, list[int]]] = ({}, {})
        self.numbers: dict[str, int] = {}
        self.words: list[str] = []
        self.signs, self.own, self.own_sizes = array("q"), array("q"), array("q")
        self.chars = 0

    def number(self, word: str) -> int:
        n = self.numbers.get(word)
        if n is None:
            n = self.numbers[word] = len(self.words)
            own = _own_features(word)
            self.words.append(word)
            self.signs.append(_code("s" + _sign(word)))
            self.own.extend(own)
            self.own_sizes.append(len(own))
            self.chars += len(own) + len(word)
        return n

    def sentence(self, sentence: str) -> list[int]:
        if _MAYBE_SPACED.search(sentence):
            sentence = _SPACED.sub(lambda m: re.sub(r"[ ._\-]", "", m[0]), sentence)
        shouted = sentence.isupper()
        known = self.pieces[shouted]
        out: list[int] = []
        for raw in sentence.split():
            own = known.get(raw)
            if own is None:
                own = known[raw] = [self.number(w) for w in _piece(raw, shouted)]
                self.chars += len(raw)
            out += own
        return out

    def tokens(self, sentence: str) -> list[str]:
        return [self.words[n] for n in self.sentence(sentence)]

    def rows(self, many: Sequence[Sequence[int]]) -> Rows:
        """Distinct features of each sentence: words, their letters, and runs of two and three words."""
        sizes = np.fromiter(map(len, many), np.int64, len(many))
        flat = np.fromiter(chain.from_iterable(many), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(many)), sizes)
        own, own_sizes = np.array(self.own, np.int64), np.array(self.own_sizes, np.int64)
        own_starts = np.cumsum(own_sizes) - own_sizes
        n = own_sizes[flat]
        single = own[np.repeat(own_starts[flat] - (np.cumsum(n) - n), n) + np.arange(n.sum())] if len(flat) else flat
        a = np.array(self.signs, np.int64)[flat] if len(flat) else flat
        pair = (a[:-1] * 1000003 ^ a[1:] * 7919 + 1) & _MASK
        triple = (a[:-2] * 1000003 ^ a[1:-1] * 7919 ^ a[2:] * 104729 + 2) & _MASK
        two, three = owner[:-1] == owner[1:], owner[:-2] == owner[2:]
        keys = np.concatenate([np.repeat(owner, n) << FEATURE_BITS | single, (owner[:-1] << FEATURE_BITS | pair)[two], (owner[:-2] << FEATURE_BITS | triple)[three]])
        keys.sort()  # np.unique of many integers is far slower
        keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
        return Rows(keys & _MASK, np.bincount(keys >> FEATURE_BITS, minlength=len(many)))

    def make_room(self) -> None:
        if self.chars > KEPT_CHARS:
            self._forget()


class _Swaps:
    """Group names of sentences swapped for others of their kind and language."""

    def __init__(self, lines: Sequence[Sequence[str]]):
        self.other: dict[str, list[str]] = {}
        spans = []
        for line in lines:
            own = list(dict.fromkeys(w for term in line for w in _piece(plain(term), True)))
            for at, word in enumerate(own):
                others = self.other.setdefault(word, [])
                others += [o for o in (own[(at + 1) % len(own)], own[(at + len(own) // 2) % len(own)]) if o != word and o not in others]
                if _CJK.search(word):
                    spans.append(word)
        self.inside = re.compile("|".join(sorted(map(re.escape, spans), key=len, reverse=True))) if spans else None

    def _swap(self, word: str, nth: int) -> str:
        others = self.other.get(word)
        if others:
            return others[nth % len(others)]
        if self.inside and not word.isascii():  # without blanks between words
            return self.inside.sub(lambda m: self.other[m[0]][nth % len(self.other[m[0]])], word)
        return word

    def of(self, words: Sequence[str]) -> list[list[str]]:
        """The sentence with all its group names swapped, in two ways."""
        out = []
        for nth in (0, 1):
            swapped = [self._swap(w, nth) for w in words]
            if swapped != list(words) and swapped not in out:
                out.append(swapped)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AbuseModel:
    weights: np.ndarray
    bias: float
    threshold: float

    def scores(self, rows: Rows) -> np.ndarray:
        return _sigmoid(rows.dot(self.weights) + self.bias)

    def score_texts(self, texts: Sequence[str | None], known: Vocabulary) -> np.ndarray:
        """Each text's score: that of its highest sentence, 0 without any."""
        split = [sentences(t) for t in texts]
        of_text = np.repeat(np.arange(len(split)), [len(s) for s in split])
        place: dict[str, int] = {}
        which = np.fromiter((place.setdefault(s, len(place)) for s in chain.from_iterable(split)), np.int64, len(of_text))
        distinct = list(place)
        value = np.zeros(len(distinct))
        for at in range(0, len(distinct), AT_ONCE):
            known.make_room()
            part = [known.sentence(s) for s in distinct[at : at + AT_ONCE]]
            value[at : at + AT_ONCE] = self.scores(known.rows(part))
        out = np.zeros(len(split))
        np.maximum.at(out, of_text, value[which])
        return out


def fit(
    documents: list[tuple[str, float]],
    identity_terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    swap_penalty: float = 1.0,
    l2: float = 2e-6,
    rounds: int = 5,
    steps: int = 40,
    threshold: float = 0.5,
    trusted: float = 0.95,
    rest_weight: float = 0.2,
) -> AbuseModel:
    """Fit on labelled documents (text, share of raters who call it abusive).

    Documents are labelled, sentences are scored, and a document's score is its
    highest sentence's. So in each round the sentences of abusive documents that
    score above one half are taken as abusive, and the best one besides if it
    scores higher than ``trusted`` of the other documents' best ones; all
    sentences of other documents are not, those left over in abusive ones count
    ``rest_weight`` as not. Then the weights are fitted again. Raters err, so
    the choice in one half of the documents is made by weights fitted on the
    other: a document in which nothing resembles other abusive ones loses its
    label. The penalty is the mean squared change of a sentence's score (log
    odds) when its group names are swapped for others of the same language.

    Without abusive documents to learn from, nothing is flagged.
    """
    known = Vocabulary()
    place: dict[tuple[int, ...], int] = {}
    members: list[tuple[float, np.ndarray]] = []
    for text, label in documents:
        own = {place.setdefault(tuple(w), len(place)) for s in sentences(text) if (w := known.sentence(s))}
        members.append((label, np.fromiter(own, np.int64, len(own))))
    distinct = list(place)
    if not distinct or not any(label > 0.5 for label, _ in members):
        return AbuseModel(np.zeros(_MASK + 1), -30.0, threshold)
    rows = known.rows(distinct)
    swaps = _Swaps(identity_terms)
    pairs = [(i, [known.number(w) for w in c]) for i, ids in enumerate(distinct) for c in swaps.of([known.words[n] for n in ids])]
    swapped, source = known.rows([ids for _, ids in pairs]), np.array([i for i, _ in pairs], np.int64)
    # Features of a single sentence teach nothing about others.
    used = np.bincount(rows.flat, minlength=_MASK + 1) > 1
    used[swapped.flat] = True
    columns = np.cumsum(used) - 1
    rows, swapped = (r.only(used, columns) for r in (rows, swapped))

    n, m_columns = len(distinct), int(used.sum())
    count = lambda parts: np.bincount(np.concatenate([*parts, np.array([], np.int64)]), minlength=n).astype(float)
    good = [(i, m) for i, (y, m) in enumerate(members) if y < 0.5 and len(m)]
    bad = [(i, m) for i, (y, m) in enumerate(members) if y > 0.5 and len(m)]
    # At first a sentence's features speak for it by how much oftener abusive documents have them.
    features_of = lambda m: list({*chain.from_iterable(rows.flat[rows.starts[i] : rows.starts[i] + rows.sizes[i]].tolist() for i in m)})
    in_bad, in_good = np.zeros(m_columns), np.zeros(m_columns)
    for docs, seen in ((bad, in_bad), (good, in_good)):
        for _, m in docs:
            seen[features_of(m)] += 1
    ratio = np.log((in_bad + 0.3) / (len(bad) + 1)) - np.log((in_good + 1.0) / (len(good) + 1))
    score = rows.dot(np.where(in_bad + in_good >= 2, np.clip(ratio, -2, 4), 0.0))
    chosen = {i: m[[score[m].argmax()]] for i, m in bad}

    def fitted(docs: Sequence[int]) -> tuple[np.ndarray, float]:
        keep = set(docs)
        rest = [np.setdiff1d(m, chosen[i]) for i, m in bad if i in keep]
        positive = count([chosen[i] for i, _ in bad if i in keep])
        negative = count([m for i, m in good if i in keep]) + rest_weight * count(rest) * (positive == 0)
        return _logistic(rows, positive, negative, swapped, source, m_columns, l2, swap_penalty, steps)

    every = range(len(members))
    for _ in range(rounds):
        # A half's sentences are chosen by what the other half taught: what was judged wrongly can't vouch for itself.
        renewed = {}
        for half in (0, 1):
            weights, bias = fitted([i for i in every if i % 2 != half])
            score = rows.dot(weights) + bias
            others = [score[m].max() for i, m in good if i % 2 == half]
            doubt = np.quantile(others, trusted) if others else 0.0
            renewed |= {i: m[score[m] > min(0.0, max(doubt, score[m].max() - 1e-9))] for i, m in bad if i % 2 == half}
        chosen = renewed
    own, bias = fitted(every)
    weights = np.zeros(_MASK + 1)
    weights[used] = own
    return AbuseModel(weights, bias, threshold)


def _logistic(rows: Rows, positive: np.ndarray, negative: np.ndarray, swapped: Rows, source: np.ndarray, columns: int, l2: float, swap_penalty: float, steps: int):
    """Weighted logistic loss plus penalties, by Adam over all rows."""
    # A frequent sentence counts more than a rare one, but not in proportion.
    total = positive + negative
    weight = np.where(total > 0, np.sqrt(total), 0.0)
    target = np.divide(positive, total, out=np.zeros_like(total), where=total > 0)
    balance = np.sqrt((weight * (1 - target)).sum() / max(1e-9, (weight * target).sum()))
    weight = weight * (1 + (balance - 1) * target)
    size = weight.sum()
    share = swap_penalty * weight[source] / max(1e-9, weight[source].sum())
    weights, bias = np.zeros(columns), -2.0
    m, v = np.zeros(columns + 1), np.zeros(columns + 1)
    for step in range(1, steps + 1):
        plain_score = rows.dot(weights)
        z = plain_score + bias
        r = weight * (_sigmoid(z) - target) / size
        grad = np.append(rows.back(r, columns) + l2 * weights, r.sum())
        if len(source):
            change = plain_score[source] - swapped.dot(weights)
            pull = 2 * share * change
            grad[:-1] += rows.back(np.bincount(source, pull, minlength=len(rows.sizes)), columns) - swapped.back(pull, columns)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        change_by = 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights = weights - change_by[:-1]
        bias -= change_by[-1]
    return weights, bias


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> list[tuple[str, float]]:
    """Labelled documents with the share of raters that call them abusive, at most ``most``.

    Null judgements and texts are left out; a rater counts once per document
    (repeated rows change nothing); documents are chosen by a hash of their id,
    among those of up to MOST_LABELLED_CHARS characters.
    """
    votes = labels.where("abusive IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id", "rater").agg(F.max("abusive").alias("abusive")).groupBy("doc_id").agg(F.avg(F.col("abusive").cast("double")).alias("share"))
    texts = documents.where(F.char_length("text") <= MOST_LABELLED_CHARS).select("doc_id", "text")
    rows = texts.join(votes, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "text", "share").collect()
    return [(r[1], r[2]) for r in sorted(rows, key=lambda r: r[0])]


def score_documents(documents: DataFrame, model: AbuseModel, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """A score from 0 to 1 for each document and whether it is flagged: doc_id, score, flagged, and the columns ``keep``.

    The score is the highest of the document's sentences; every sentence of the
    whole text counts. Null and empty texts score 0. A row in, a row out, without
    a shuffle; the model has a fixed size and is sent to the executors.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias, model.threshold))
    read = documents.select(F.col(text).alias("text"), F.col(doc_id).alias("doc_id"), *keep)
    out = T.StructType([read.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("flagged", T.BooleanType()), *[read.schema[c] for c in keep]])
    names = out.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = AbuseModel(*shared.value), Vocabulary()
        for batch in batches:
            scores = own.score_texts(batch.column(0).to_pylist(), known)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(scores), pa.array(scores >= own.threshold), *batch.columns[2:]], names=names)

    return read.mapInArrow(run, out)


def rates(scored: DataFrame, by: str) -> DataFrame:
    """Per value of ``by`` (null is one): documents, those flagged, their share and the mean score."""
    return scored.groupBy(by).agg(
        F.count("*").alias("documents"), F.count_if("flagged").alias("flagged"), F.avg(F.col("flagged").cast("double")).alias("rate"), F.avg("score").alias("mean_score")
    )
