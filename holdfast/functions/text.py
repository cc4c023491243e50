"""Name normalisation as one column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.collected import bounded
from ..specs import TextSpec


# Spark's default English stop words.
ENGLISH_STOPWORDS = tuple(
    """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t
can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've
we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't
cannot could here's how's let's ought that's there's what's when's where's who's why's would
""".split()
)


def lower_case(c: Column) -> Column:
    return F.lower(c)


def remove_punc(c: Column, unicode: bool = False) -> Column:
    """Without the flag accented letters go too."""
    return F.regexp_replace(c, r"(?U)[^\w\s]" if unicode else r"[^\w\s]", "")


def remove_nums(c: Column) -> Column:
    """Digits and plus signs go."""
    return F.regexp_replace(c, r"[\d+]", "")


def replace_values(c: Column, values: dict[str, str]) -> Column:
    """Each pattern in turn, inside words as well; plain letters need no regular expression."""
    for old, new in values.items():
        c = F.replace(c, F.lit(old), F.lit(new)) if old.isalnum() and new.isalnum() else F.regexp_replace(c, old, new)
    return c


def tokens(c: Column, min_length: int = 1, unicode: bool = False, lowered: bool = False) -> Column:
    """The words of at least min_length characters, in lower case (lowered: the text is)."""
    parts = F.split(c if lowered else F.lower(c), r"(?U)\W" if unicode else r"\W")
    return F.array_remove(parts, "") if min_length <= 1 else F.filter(parts, lambda t: F.length(t) >= min_length)


def remove_stopwords(c: Column, extra: tuple[str, ...] = (), min_length: int = 1, lowered: bool = False) -> Column:
    """Stop words go, whatever their case (lowered: the tokens are), as do tokens of fewer than min_length characters; repeated tokens stay."""
    shortest = min_length if min_length > 1 else 0
    words = [w for w in dict.fromkeys(w.lower() for w in (*ENGLISH_STOPWORDS, *extra)) if len(w) >= shortest]

    def stays(t: Column) -> Column:
        other = ~(t if lowered else F.lower(t)).isin(words)  # a list of this length becomes a hash set
        return (F.length(t) >= min_length) & other if shortest else other

    return F.filter(c, stays)


def sort_tokens(c: Column) -> Column:
    return F.sort_array(c)  # compiled, unlike array_sort with its comparator; there are no nulls


def cleaned(c: Column, spec: TextSpec) -> Column:
    """The steps of a spec before its tokens."""
    if spec.lower_case:
        c = lower_case(c)
    if spec.remove_punc:
        c = remove_punc(c, spec.unicode)
    if spec.remove_nums:
        c = remove_nums(c)
    return replace_values(c, spec.replace)


def all_tokens(c: Column, spec: TextSpec) -> Column:
    """The tokens of a text, before those that the spec leaves out."""
    return tokens(cleaned(c, spec), 1, spec.unicode, spec.lower_case and all(v == v.lower() for v in spec.replace.values()))


def chosen(words: Column, spec: TextSpec) -> Column:
    """Of all_tokens those that the spec keeps, in its order."""
    if spec.remove_stopwords:
        words = remove_stopwords(words, spec.extra_stopwords, spec.min_token_length, lowered=True)
    elif spec.min_token_length > 1:
        words = F.filter(words, lambda t: F.length(t) >= spec.min_token_length)
    return sort_tokens(words) if spec.sort_tokens else words


def normalise(c: Column, spec: TextSpec) -> Column:
    """A string, or its token list if the spec tokenises; null stays null."""
    return chosen(all_tokens(c, spec), spec) if spec.tokenize else cleaned(c, spec)


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """(id, exploded, count): each token, how often it occurs, and how many tokens occur more often.

    Ranks come from the counts of counts, of which there are few, not from one
    ordering of all tokens.
    """
    counts = df.select(F.explode(tokens(F.col(column))).alias("exploded")).groupBy("exploded").agg(F.count("*").alias("count"))
    sizes = counts.groupBy("count").agg(F.count("*").alias("n"))
    above = Window.orderBy(F.desc("count")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = sizes.select(F.col("count").alias("size"), F.coalesce(F.sum("n").over(above), F.lit(0)).cast("int").alias("id"))
    return counts.join(ranks, counts["count"] == ranks["size"]).select("id", "exploded", "count")


def top_words(df: DataFrame, column: str, n: int, most: int = 10_000) -> list[str]:
    """The tokens with fewer than n tokens above them, ties included, in order; an error if there are more than `most`."""
    counts = df.select(F.explode(tokens(F.col(column))).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("r", F.rank().over(Window.orderBy(F.desc("n")))).where(F.col("r") <= n)
    return sorted(r.t for r in bounded(ranked, most, f"words of {column}"))
