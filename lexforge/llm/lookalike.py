"""One form for texts that look the same in different characters.

A text becomes a *skeleton*: width forms, composed accents, blanks and ignorable characters are normalized and letters
drawn alike are mapped to one class each. Each class is then a column of a lattice: the members of the class and, at a
price, those of the classes it is easily taken for (a capital I inside a word for an l, a Greek rho for a p). A Viterbi
search picks the most plausible reading of each token under character bigrams counted over the whole corpus, with a
price for changes of script and of case; the reading is the text's form. The search sees only the skeleton, so equal
looks give equal forms; different skeletons share a form only where the context makes both read the same.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.operators.skew import attach
from lexforge.session import materialize

# Letters and signs drawn alike. Each line is a class; its first member names the class.
LOOKALIKES = (
    "A Α А Ꭺ", "B Β В Ᏼ", "C С Ϲ Ꮯ Ⅽ", "D Ꭰ Ⅾ", "E Ε Е Ꭼ", "F Ϝ", "H Η Н Ꮋ", "I Ι І Ӏ Ꮖ Ⅰ", "J Ј Ϳ Ꭻ", "K Κ К Ꮶ", "L Ꮮ Ⅼ", "M Μ М Ꮇ Ⅿ", "N Ν", "O Ο О Օ", "P Ρ Р Ꮲ", "Q Ԛ", "R Ꭱ",
    "S Ѕ Տ Ꮪ", "T Τ Т Ꭲ", "V Ѵ Ꮩ Ⅴ", "W Ԝ Ꮃ", "X Χ Х Ⅹ", "Y Υ Ү", "Z Ζ Ꮓ", "G Ԍ Ꮐ", "U Ս",
    "a а ɑ", "c с ϲ ᴄ ⅽ", "d ԁ ⅾ", "e е", "g ɡ", "h һ հ", "i і ⅰ", "j ј ϳ", "l ⅼ", "m ⅿ", "n ո", "o ο о օ ᴏ", "p р", "q ԛ", "s ѕ ꜱ", "u ս", "v ν ѵ ᴠ ⅴ", "w ԝ ᴡ", "x х ⅹ", "y у", "z ᴢ",
    "ʙ в", "ʜ н", "ᴋ к ĸ", "ᴍ м", "ᴛ т",
    "カ 力", "エ 工", "タ 夕", "ニ 二", "ハ 八", "ロ 口", "ト 卜", "ー 一", "ノ 丿",
    "ヘ へ", "リ り", "ベ べ", "ペ ぺ",
    "- ‐ ‑ ‒ – − ﹣", "' ’ ʼ ′", "\" “ ” ″", "・ · ‧", ": ： ∶", "/ ⁄ ∕",
)

# Classes that are easily taken for each other, though they are told apart where both make sense.
NEAR = ("l I 1", "O 0", "o 0", "p ρ", "a α", "u υ", "n η", "w ω", "y γ", "k ᴋ", "B ß")

# Characters that show nothing besides the categories Cf and the variation selectors.
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ"


@lru_cache(maxsize=1)
def classes() -> tuple[dict[str, str], dict[str, str]]:
    """(character -> class name, class name -> members)."""
    to: dict[str, str] = {}
    members: dict[str, str] = {}
    for line in LOOKALIKES:
        chars = line.split(" ")
        for ch in chars:
            to[ch] = chars[0]
        members[chars[0]] = "".join(chars)
    return to, members


@lru_cache(maxsize=1)
def near() -> dict[str, tuple[str, ...]]:
    """Class name -> names of the classes it is easily taken for."""
    out: dict[str, tuple[str, ...]] = {}
    for line in NEAR:
        names = line.split(" ")
        for name in names:
            out[name] = out.get(name, ()) + tuple(x for x in names if x != name)
    return out


def _shows_nothing(ch: str) -> bool:
    code = ord(ch)
    return unicodedata.category(ch) == "Cf" or ch in INVISIBLE or 0xFE00 <= code <= 0xFE0F or 0xE0000 <= code <= 0xE0FFF


@lru_cache(maxsize=65536)
def _compatible(ch: str) -> str:
    """Width forms, blanks, ligatures and radicals as plain characters; raised, circled and similar forms stay."""
    mapping = unicodedata.decomposition(ch)
    if mapping.startswith("<"):
        kind = mapping[1 : mapping.index(">")]
        plain = unicodedata.normalize("NFKC", ch)
        ligature = kind == "compat" and unicodedata.category(ch) in ("Ll", "Lu") and 0xFB00 <= ord(ch) <= 0xFB17
        radical = kind == "compat" and len(plain) == 1 and 0x2E80 <= ord(ch) <= 0x2FDF
        if kind in ("wide", "narrow", "noBreak", "font", "initial", "medial", "final", "isolated") or ligature or radical:
            return plain
    if unicodedata.category(ch) in ("Zs", "Zl", "Zp") or ch in "\t\n\v\f\r\x85":
        return " "
    return ch


def plain(text: str) -> str:
    """``text`` after compatibility normalization, with ignorable characters deleted and blanks made one."""
    if text.isascii() and text.isprintable():
        return " ".join(text.split())
    kept = "".join(_compatible(ch) for ch in text if not _shows_nothing(ch))
    # Half-width voicing marks are combining marks by now and compose with the letter before them.
    composed = unicodedata.normalize("NFC", kept.replace("゛", "\u3099").replace("゜", "\u309a"))
    return " ".join(composed.split())


def look(text: str) -> str:
    """The classes of a plain text's characters."""
    to, _ = classes()
    if text.isascii():
        return "".join(to.get(ch, ch) for ch in text) if '"' in text or "'" in text else text
    parts = "".join(to.get(ch, ch) for ch in _split_lookalike(text))
    return unicodedata.normalize("NFC", parts)


def skeleton(text: str) -> str:
    """The look of a text: equal for texts that look the same, different otherwise."""
    return look(plain(text))


def _split_lookalike(text: str) -> str:
    """Letters of Greek or Cyrillic with an accent as letter and accent, so that the letter can be classed."""
    out = []
    for ch in text:
        if 0x370 <= ord(ch) <= 0x52F or 0x1F00 <= ord(ch) <= 0x1FFF:
            d = unicodedata.normalize("NFD", ch)
            out.append(d if d[0] in classes()[0] else ch)
        else:
            out.append(ch)
    return "".join(out)


@lru_cache(maxsize=65536)
def script(ch: str) -> str:
    """Coarse script of a letter, or '' for others."""
    if not ch.isalpha() and ch not in "ー〆":
        return ""
    name = unicodedata.name(ch, "")
    head = name.split(" ", 1)[0].split("-", 1)[0]
    return "KATAKANA" if head in ("KATAKANA", "HALFWIDTH") else head


#: Characters of large scripts count as their script in the bigram model, which bounds it by the alphabets.
_MARKS = {"CJK": "\x13", "HANGUL": "\x14", "": "\x16"}
_EAST = {"KATAKANA", "HIRAGANA", "CJK"}


@lru_cache(maxsize=65536)
def mark(ch: str) -> str:
    """A character as the model sees it.

    Letters of the Latin, Greek, Cyrillic and Armenian blocks, kana, digits and look-alikes count as themselves, signs
    and blanks as one, all other letters as their script.
    """
    code = ord(ch)
    if ch in "\x02\x03" or ch in classes()[0] or ((code < 0x590 or 0x3041 <= code <= 0x30FF) and (ch.isalnum() or ch == "ー")):
        return ch
    return _MARKS.get(script(ch), "\x17")


@lru_cache(maxsize=65536)
def _case(ch: str) -> str:
    return "U" if ch.isupper() else "l" if ch.islower() else ""


class Reader:
    """Viterbi search over look-alike lattices with smoothed character bigrams.

    ``change`` is the price of changing the script between two letters, ``rise`` that of a capital after a small letter,
    ``mistake`` that of reading a class as one it is easily taken for.
    """

    def __init__(self, bigrams: dict[str, float], change: float = 6.0, rise: float = 3.0, mistake: float = 6.0):
        self.change, self.rise, self.mistake = change, rise, mistake
        self.pair = bigrams
        self.first: Counter[str] = Counter()
        for k, v in bigrams.items():
            self.first[k[0]] += v
        self.size = 1 + len({k[1] for k in bigrams})
        self.members = classes()[1]
        self.options = lru_cache(maxsize=4096)(self._options)
        self.step = lru_cache(maxsize=200_000)(self._step)
        self.token = lru_cache(maxsize=200_000)(self._token)

    def _options(self, name: str) -> tuple[tuple[str, float], ...]:
        """Readings of a class with their prices: its members, then those of the classes it is taken for."""
        own = [(c, 0.0) for c in self.members.get(name, name)]
        return (*own, *((c, self.mistake) for other in near().get(name, ()) for c in self.members.get(other, other)))

    def _step(self, a: str, b: str) -> float:
        score = math.log((self.pair.get(mark(a) + mark(b), 0.0) + 1.0) / (self.first.get(mark(a), 0.0) + self.size))
        x, y = script(a), script(b)
        if x and y and x != y and not {x, y} <= _EAST:
            score -= self.change
        return score - self.rise if _case(a) == "l" and _case(b) == "U" else score

    def _token(self, token: str) -> str:
        """Best reading of one token of a skeleton; ties go to the option named first."""
        if not any(len(self.options(ch)) > 1 for ch in set(token)):
            return token
        best: list[tuple[float, str, tuple]] = [(0.0, "\x02", ())]
        for ch in token + "\x03":
            grown = []
            for option, price in self.options(ch):
                score, last, trail = max(((s + self.step(c, option), c, t) for s, c, t in best), key=lambda x: x[0])
                grown.append((score - price, option, (trail, last)))
            best = grown
        out, trail = [], best[0][2]
        while trail:
            trail, ch = trail
            out.append(ch)
        return "".join(reversed(out[:-1]))

    def read(self, look: str) -> str:
        return " ".join(self.token(t) for t in look.split(" "))


def with_skeleton(df: DataFrame, text: Column, name: str = "skeleton") -> DataFrame:
    """``df`` plus the skeleton of ``text`` (null for null, '' for a text that shows nothing)."""

    @F.pandas_udf("string")
    def looks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: None if t is None else skeleton(t))

    return df.withColumn(name, looks(text))


def bigram_counts(texts: DataFrame, column: str) -> dict[str, float]:
    """Character bigrams of the tokens of all rows.

    Counted per batch first, then over all rows. The characters of alphabets and look-alikes count as themselves, all
    others as their script, so at most some 1,900 squared, and in practice some ten thousand, pairs reach the driver,
    however large the corpus.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: Counter[str] = Counter()
            for t in pdf[column]:
                for token in plain(t).split(" ") if t is not None else ():
                    marks = "\x02" + "".join(map(mark, token)) + "\x03"
                    seen.update(map("".join, zip(marks, marks[1:])))
            if seen:
                yield pd.DataFrame({"pair": list(seen), "n": list(seen.values())})

    partial = texts.select(column).mapInPandas(count, "pair string, n long")
    return {r["pair"]: float(r["n"]) for r in partial.groupBy("pair").agg(F.sum("n").alias("n")).collect()}


def canonical_forms(texts: DataFrame, column: str, *, name: str = "canonical") -> DataFrame:
    """``texts`` plus one form per look. Null stays null, a text that shows nothing becomes ''.

    The bigram statistics are counted over all rows first; the model's size is bounded by the alphabets.
    """
    model = texts.sparkSession.sparkContext.broadcast(bigram_counts(texts, column))

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model.value)
        for s in batches:
            yield s.map(lambda t: None if t is None else reader.read(skeleton(t)))

    return texts.withColumn(name, read(F.col(column)))


def look_classes(keyed: DataFrame, key: str, text: str) -> DataFrame:
    """(text, canonical, keys, spellings, class_keys): each distinct text with the class of its look.

    ``keys`` counts the distinct keys of the text, ``spellings`` and ``class_keys`` the texts and keys of its class. Null
    keys and texts are left out; a text that shows nothing has the form ''.
    """
    texts = keyed.filter(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("text")).distinct()
    # the forms are searched once for each text and written
    spellings = materialize(canonical_forms(texts.groupBy("text").agg(F.count(F.lit(1)).alias("keys")), "text"), "forms")
    totals = spellings.groupBy("canonical").agg(F.count(F.lit(1)).alias("spellings"), F.sum("keys").alias("class_keys"))
    return spellings.join(totals, "canonical").select("text", "canonical", "keys", "spellings", "class_keys")


#: Keys of a class that meet in one task when its pairs are made.
PAIR_KEYS = 1000


def lookalike_pairs(keyed: DataFrame, key: str, text: str) -> DataFrame:
    """(key_1, key_2): distinct pairs of different keys with texts that look the same and differ in their characters.

    Copies are removed before the search runs, and only texts of classes with several spellings are joined, different
    spelling against different spelling; texts that are equal never meet. A spelling that very many keys share is not
    shuffled to its class, and a class is spread over as many salts as its counted keys ask for. Rows with a null key or
    text are left out; a text that shows nothing has the empty form and pairs with every other such text that is written
    differently; repeated rows count once.
    """
    spelled = materialize(look_classes(keyed, key, text), "looks")
    texts = keyed.filter(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("text")).distinct()
    total = spelled.agg(F.sum("keys")).first()[0] or 0
    verdicts = spelled.select("text", F.when(F.col("spellings") > 1, F.col("canonical")).alias("_form"), F.ceil(F.col("class_keys") / PAIR_KEYS).cast("int").alias("_salts"), "keys")
    members = attach(texts, verdicts, ["text"], weight="keys", total=total).filter("_form is not null")
    left = members.select("_form", F.col("text").alias("_ta"), F.col("_key").alias("_ka"), F.pmod(F.xxhash64("_key"), F.col("_salts")).cast("int").alias("_salt"))
    right = members.select(F.col("_form").alias("_f"), F.col("text").alias("_tb"), F.col("_key").alias("_kb"), F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_s"))
    pairs = left.join(right, (F.col("_form") == F.col("_f")) & (F.col("_salt") == F.col("_s")) & (F.col("_ta") < F.col("_tb")) & (F.col("_ka") != F.col("_kb")))
    return pairs.select(F.least("_ka", "_kb").alias("key_1"), F.greatest("_ka", "_kb").alias("key_2")).distinct()


def article_and_alias_texts(articles: DataFrame, aliases: DataFrame) -> DataFrame:
    """(key, text): names of all article rows under identifier, titles of all aliases under alias_id."""
    names = articles.select(F.col("identifier").alias("key"), F.col("name").alias("text"))
    titles = aliases.select(F.col("alias_id").alias("key"), F.col("title").alias("text"))
    return names.unionByName(titles).filter("key is not null and text is not null")
