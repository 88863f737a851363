"""Problem 8: evaluation passages in training text, by a distributed positional inverted index.

The index holds a posting (term, doc, position) for every occurrence in the corpus of a word that some item has. Each
stretch of an item that could be a leaked phrase is looked up by its rarest term; its postings, less the term's place in
the item, give the diagonals on which document and item may agree. On these the postings of all the item's terms are
intersected, and runs of consecutive agreement are exact phrases. Agreement nearby, in order or not, is a proximity match;
these have candidates of their own, since a near match need not hold any exact stretch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parlance.functions.text import words
from parlance.operators.skew import bounded_semi_filter
from parlance.session import materialize

from .confusables import PROTOTYPE, normalized, not_ascii

#: Up to so many item words the vocabulary is broadcast (some 100 MB at most); beyond, postings are found by a shuffle.
BROADCAST_WORDS = 2_000_000
#: Of the words that a proximity match asks for, one in so many must be among the item's rare ones for it to be looked at.
#: Fewer leave more bands to be looked at, more make seeds of frequent words.
RARE = 3


#: Lower-case letters of other alphabets and the Latin letters that they look like.
_LOW = {c: p for c, p in PROTOTYPE.items() if c.islower() and p.islower()}


def unmasked(term: Column) -> Column:
    """A word of a text in one form; one made of look-alikes only, on which form can't decide, by its prototype."""
    own, latin = "".join(_LOW), "".join(_LOW.values())
    return F.when(not_ascii(term) & term.rlike(f"^[{own}]+$"), F.translate(term, own, latin)).otherwise(term)


def _broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


class Index:
    """Postings of the items' words over the whole corpus, written to the shared folder.

    Texts are compared in their one form (problem 9). Null and empty texts have no postings. Items shorter than
    ``phrase`` words have no phrases. Documents of one id count as one.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, phrase: int = 13):
        self.phrase = phrase
        item_words = normalized(items, "item_id").select(F.col("doc_id").alias("item_id"), F.posexplode(words(F.col("clean"))).alias("ipos", "term")).withColumn("term", unmasked(F.col("term")))
        item_words = materialize(item_words, "item-words")
        n = item_words.count()
        self.small = n <= BROADCAST_WORDS
        self.items = materialize(item_words.select("item_id", "ipos", F.xxhash64("term").alias("t")), "items")
        vocabulary = materialize(self.items.select("t").distinct(), "vocabulary")
        spelled = normalized(docs).select("doc_id", F.posexplode(words(F.col("clean"))).alias("pos", "term")).select(F.xxhash64(unmasked(F.col("term"))).alias("t"), "doc_id", "pos")
        self.postings = materialize(spelled.join(_broadcast_if(vocabulary, self.small), "t", "left_semi"), "postings")

    def seeds(self) -> DataFrame:
        """(item_id, seed, seed_t, ipos, t): of every stretch of ``phrase`` words its rarest term, and the next two rarest with it.

        A stretch with a term that isn't in the corpus can't be there, so it has no seed.
        """
        df = self.postings.groupBy("t").agg(F.count("*").alias("df"))
        ranked = self.items.join(df, "t", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        ahead = Window.partitionBy("item_id").orderBy("ipos").rowsBetween(0, self.phrase - 1)
        best = ranked.select("item_id", F.slice(F.array_sort(F.collect_list(F.struct("df", "ipos", "t")).over(ahead)), 1, 3).alias("best"), F.count("*").over(ahead).alias("n"))
        best = best.filter(f"n = {self.phrase} and best[0].df > 0").select("item_id", F.col("best")[0]["ipos"].alias("seed"), F.col("best")[0]["t"].alias("seed_t"), F.explode(F.slice("best", 2, 2)).alias("b"))
        return best.select("item_id", "seed", "seed_t", "b.ipos", "b.t").distinct()

    def candidates(self) -> DataFrame:
        """(doc_id, item_id, shift): diagonals on which a seed and two terms that go with it all have postings.

        Intersects from the rarest list on: the postings of a seed, shifted by its place in the item, meet the shifted
        postings of its companions.
        """
        seeds = materialize(self.seeds(), "seeds")
        first = seeds.select("item_id", "seed", F.col("seed_t").alias("t")).distinct()
        found = self.postings.join(_broadcast_if(first, self.small), "t").select("doc_id", "item_id", "seed", (F.col("pos") - F.col("seed")).alias("shift"))
        found = materialize(found, "seeded")
        wanted = found.join(_broadcast_if(seeds.select("item_id", "seed", "ipos", "t"), self.small), ["item_id", "seed"]).select("doc_id", "item_id", "seed", "shift", "ipos", "t", (F.col("shift") + F.col("ipos")).alias("pos"))
        hits = wanted.filter("pos >= 0").join(bounded_semi_filter(self.postings, found, "doc_id"), ["doc_id", "pos", "t"])
        agreed = hits.groupBy("doc_id", "item_id", "seed", "shift").agg(F.countDistinct("ipos").alias("n")).filter(f"n >= {min(2, self.phrase - 1)}")
        return materialize(agreed.select("doc_id", "item_id", "shift").distinct(), "diagonals")

    def _near_postings(self, candidates: DataFrame) -> DataFrame:
        return bounded_semi_filter(self.postings, candidates, "doc_id")

    def phrases(self) -> DataFrame:
        """(doc_id, item_id, doc_word, item_word, n_words): every maximal common run of ``phrase`` words or more."""
        candidates = self.candidates()
        wanted = candidates.join(_broadcast_if(self.items, self.small), "item_id").select("doc_id", "item_id", "shift", "ipos", "t", (F.col("shift") + F.col("ipos")).alias("pos"))
        hits = wanted.join(self._near_postings(candidates), ["doc_id", "pos", "t"]).select("doc_id", "item_id", "shift", "ipos").distinct()
        run = F.col("ipos") - F.row_number().over(Window.partitionBy("doc_id", "item_id", "shift").orderBy("ipos"))
        runs = hits.withColumn("run", run).groupBy("doc_id", "item_id", "shift", "run").agg(F.min("ipos").alias("item_word"), F.count("*").alias("n_words"))
        return runs.filter(F.col("n_words") >= self.phrase).select("doc_id", "item_id", (F.col("shift") + F.col("item_word")).alias("doc_word"), "item_word", "n_words")

    def near_candidates(self, slack: int, share: float) -> DataFrame:
        """(doc_id, item_id, band): bands of diagonals that hold every proximity match; band b is the 2w diagonals from w b on, w = 2 slack + 1.

        A match lacks at most n - m of an item's n words, if m are asked for. So at least k of the item's n - m + k rarest
        words, those that the corpus lacks among them, are within its w diagonals, and these lie in one band.
        """
        w = 2 * slack + 1
        df = self.postings.groupBy("t").agg(F.count("*").alias("df"))
        whole = Window.partitionBy("item_id")
        ranked = self.items.join(df, "t", "left").withColumn("rank", F.row_number().over(whole.orderBy(F.coalesce("df", F.lit(0)), "ipos"))).withColumn("n", F.count("*").over(whole))
        asked = ranked.withColumn("m", F.greatest(F.lit(1), F.ceil(F.col("n") * share - 1e-9))).withColumn("k", F.greatest(F.lit(1), F.floor(F.col("m") / RARE)))
        seeds = materialize(asked.filter("rank <= n - m + k and df > 0").select("item_id", "ipos", "t", "k"), "near-seeds")
        found = self.postings.join(_broadcast_if(seeds.drop("k"), self.small), "t").withColumn("band", F.floor((F.col("pos") - F.col("ipos")) / w))
        found = found.select("doc_id", "item_id", F.explode(F.array(F.col("band") - 1, F.col("band"))).alias("band"))
        # a word that is there several times counts as often, so none is lost, and rows are combined in one shuffle
        counted = found.groupBy("doc_id", "item_id", "band").agg(F.count("*").alias("found"))
        kept = counted.join(_broadcast_if(seeds.select("item_id", "k").distinct(), self.small), "item_id").filter("found >= k")
        return materialize(kept.select("doc_id", "item_id", "band"), "near-bands")

    def proximity(self, slack: int = 4, share: float = 0.6) -> DataFrame:
        """(doc_id, item_id, item_share): at least ``share`` of an item's words within ``slack`` places of one diagonal. Items of any length."""
        w = 2 * slack + 1
        candidates = self.near_candidates(slack, share)
        own = self.items.groupBy("item_id").agg(F.count("*").alias("length"))
        asked = candidates.join(own, "item_id")
        # places of each word on the band: 2 w from ``low`` on, in at most two cells of 2 w
        low = F.col("band") * w + F.col("ipos")
        wanted = asked.join(_broadcast_if(self.items, self.small), "item_id").withColumn("low", low).withColumn("cell", F.floor(F.col("low") / (2 * w)))
        wanted = wanted.select("doc_id", "item_id", "band", "length", "ipos", "t", "low", F.explode(F.array(F.col("cell"), F.col("cell") + 1)).alias("cell")).filter("cell >= 0")
        near = self._near_postings(candidates).withColumn("cell", F.floor(F.col("pos") / (2 * w)))
        hits = wanted.join(near, ["doc_id", "t", "cell"]).filter((F.col("pos") >= F.col("low")) & (F.col("pos") < F.col("low") + 2 * w))
        bands = hits.groupBy("doc_id", "item_id", "band", "length").agg(F.collect_set(F.struct((F.col("pos") - F.col("ipos")).alias("diagonal"), "ipos")).alias("hits"))
        bands = bands.filter(F.size(F.array_distinct("hits.ipos")) / F.col("length") >= share)
        places = bands.select("doc_id", "item_id", "length", F.explode("hits").alias("h")).select("doc_id", "item_id", "length", "h.ipos", F.explode(F.sequence(F.col("h.diagonal") - slack, F.col("h.diagonal") + slack)).alias("shift")).distinct()
        best = places.groupBy("doc_id", "item_id", "length", "shift").agg(F.count("*").alias("n")).groupBy("doc_id", "item_id", "length").agg(F.max("n").alias("n"))
        return best.select("doc_id", "item_id", (F.col("n") / F.col("length")).alias("item_share")).filter(F.col("item_share") >= share)


def leaked(docs: DataFrame, items: DataFrame, phrase: int = 13) -> DataFrame:
    """(doc_id, item_id): documents and items that share ``phrase`` or more consecutive words."""
    return Index(docs, items, phrase).phrases().select("doc_id", "item_id").distinct()
