"""Text expressions: cleaning, tokens and sentence handling, all inside the JVM."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns whose results must agree with the scripts this toolkit replaces. Word characters are spelled
# out as letters, digits and underscore because \W covers ASCII only in Java.
TAG = r"<[^>]*>"
EMOTICON = r"[:;=]-?[)(DP]"
NON_WORD = r"[^\p{L}\p{N}_]+"
WORD = r"[\p{L}\p{N}_]+"
WORD2 = r"[\p{L}\p{N}_]{2,}"
LINK = r"[\p{L}\p{N}_]+://\S+"
MENTION = r"@[A-Za-z0-9]+"
PUNCTUATION = r"!\"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"
ISSUE_SYMBOLS = [",", "'", ".", "(", ")", "{", "}", ":", "e.g", ";", "@", "{}", "()", "(^a-z)(0-9$)"]
ISSUE_STOPWORDS = ["there", "was", "the", "customer", "therefore"]
PREFIX_SYMBOLS = [",", "'", ".", "(", "{", "}", "e.g", "JDK", "SDK"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def find_all(col: Column, pattern: str) -> Column:
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(0))


def without(tokens: Column, words: Iterable[str]) -> Column:
    """Tokens that are not in a fixed word list."""
    words = list(words)
    return F.filter(tokens, lambda t: ~t.isin(words)) if words else tokens


def strip_html(col) -> Column:
    return F.regexp_replace(_col(col), TAG, "")


def extract_emoticons(col) -> Column:
    """All emoticons in a row, without their noses."""
    return F.replace(F.array_join(find_all(_col(col), EMOTICON), ""), F.lit("-"), F.lit(""))


def clean_review(col, mode: str = "spaced") -> Column:
    """Lower-cased words with the emoticons at the end; 'joined' leaves out every blank and reads emoticons first."""
    text = strip_html(col)
    if mode == "joined":
        return F.concat(F.regexp_replace(F.lower(text), NON_WORD, ""), extract_emoticons(text))
    return F.concat(F.regexp_replace(F.lower(text), NON_WORD, " "), extract_emoticons(F.lower(text)))


def tokenize_space(col) -> Column:
    return F.filter(F.split(_col(col), r"\s+"), lambda t: t != "")


def word_tokens(col, pattern: str = WORD) -> Column:
    return find_all(F.lower(_col(col)), pattern)


def tokenize_clean(col, stopwords: Iterable[str], min_len: int = 3, forms: dict[str, str] | None = None) -> Column:
    """Lower-cased words of min_len letters or more, in base form, without stop words and words with a digit."""
    tokens = F.filter(word_tokens(col), lambda t: F.length(t) >= min_len)
    if forms:
        table = F.create_map(*[F.lit(x) for pair in forms.items() for x in pair])
        tokens = F.transform(tokens, lambda t: F.coalesce(F.try_element_at(table, t), t))
    return F.filter(without(tokens, stopwords), lambda t: ~t.rlike(r"\p{Nd}"))


def process_text(col, stopwords: Iterable[str]) -> Column:
    """Words after dropping punctuation and digits; stop words are compared before lower-casing."""
    plain = F.regexp_replace(F.translate(_col(col), PUNCTUATION, ""), r"\p{Nd}", "")
    return F.transform(without(tokenize_space(plain), stopwords), lambda t: F.lower(t))


def clean_tweet(col) -> Column:
    """Links, mentions and special characters become blanks; runs of blanks collapse."""
    text = F.regexp_replace(_col(col), LINK, " ")
    text = F.regexp_replace(text, MENTION, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[^0-9A-Za-z \t]", " "), r"[ \t]+", " "))


def strip_code_format(col) -> Column:
    text = _col(col)
    for piece in ("\n", "b'", "\r", "'", "\\"):
        text = F.replace(text, F.lit(piece), F.lit(""))
    return F.trim(text)


def strip_block_comments(col) -> Column:
    """Closed comments first, then a comment that began before the text."""
    return F.regexp_replace(F.regexp_replace(_col(col), r"(?s)/\*.*?\*/", ""), r"(?s)^.*\*/", "")


def ascii_only(col) -> Column:
    return F.regexp_replace(_col(col), r"[^\x00-\x7F]", "")


def issue_tokens(col, stopwords: Iterable[str] = ISSUE_STOPWORDS, symbols: Iterable[str] = ISSUE_SYMBOLS) -> Column:
    """Blank-separated tokens of one or of more than two characters, without symbols and stop words."""
    tokens = F.filter(F.split(F.lower(_col(col)), " "), lambda t: (F.length(t) > 2) | (F.length(t) == 1))
    return without(without(tokens, symbols), stopwords)


def tokenize_issue(col, stopwords: Iterable[str] = ISSUE_STOPWORDS, symbols: Iterable[str] = ISSUE_SYMBOLS) -> Column:
    return F.array_join(issue_tokens(col, stopwords, symbols), " ")


def numeric_tokens(tokens: Column) -> Column:
    """Tokens that contain a digit."""
    return F.filter(tokens, lambda t: t.rlike(r"\p{Nd}"))


def split_sentences(col) -> Column:
    return F.split(_col(col), r"\.")


def prefix_phrases(tokens: Column, symbols: Iterable[str] = PREFIX_SYMBOLS) -> Column:
    """The growing prefix at each kept token."""
    kept = without(tokens, symbols)
    return F.transform(kept, lambda t, i: F.array_join(F.slice(kept, F.lit(1), i + 1), " "))


def phrase_runs(col, stopwords: Iterable[str]) -> Column:
    """Runs of words between stop words and punctuation."""
    marked = F.regexp_replace(F.lower(_col(col)), r"[^\p{L}\p{N}_\s]+", " | ")
    words = list(stopwords)
    cut = F.transform(tokenize_space(marked), lambda t: F.when(t.isin(words), "|").otherwise(t))
    return F.filter(F.transform(F.split(F.array_join(cut, " "), r"\|"), lambda p: F.trim(p)), lambda p: p != "")
