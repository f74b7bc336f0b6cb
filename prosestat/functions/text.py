"""Text measures as Column expressions; all stay inside the JVM.

Every builder takes a text column of any length: a book, a line, a word.
Tokens never cross a line end, so measuring a body equals the sum over its lines.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from string import ascii_lowercase

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosestat.constants import (
    ABBREVIATIONS, COMPLEX_SYLLABLES, FREQUENCY_STOPWORDS, VOCABULARY_STOPWORDS,
)

# Unicode white space plus the four separator controls.
WS = r"[\s\x1C-\x1F]"
NON_BLANK = r"(?U)[^\s\x1C-\x1F]"

# The characters of WS, one by one.
WS_CHARS = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

# A run of letters and inner apostrophes with no letter, digit or "_" on either
# side. Letters outside a-z count as neighbours, which drops "naïve" and "x1".
WORD = r"(?<![\p{L}\p{N}_])[a-z](?:[a-z']*[a-z])?(?![\p{L}\p{N}_])"

# A sentence ends at a line end, or at . ! ? before white space or the text's end.
SENTENCE_END = rf"(?U)\n|[.!?]+(?:{WS}+|\z)"

# A sentence end in a text that ends in a line end, with the blank sentences after it.
SENTENCE_GAP = (rf"(?U)[\n.!?](?:(?<=\n)|(?<!{'|'.join(map(re.escape, ABBREVIATIONS))})[.!?]*+{WS})"
                rf"{WS}*+(?:[.!?]++{WS}++)*+")

# What a line of words (``line_of``) holds, a match for each: vowel groups, final
# silent e's that are one, words without another, words of COMPLEX_SYLLABLES or more.
# Classes name each sign, which is faster than ranges and negations.
_SIGN, _CONSONANT = f"[{ascii_lowercase}']", "[bcdfghjklmnpqrstvwxz']"
VOWELS = "[aeiouy]++"
SILENT = f"e (?<={_SIGN}{_CONSONANT}e )"
NO_VOWEL = f" {_CONSONANT}++(?:(?<={_SIGN}{{2}})e)?+(?= )"
COMPLEX = f" {_CONSONANT}*+(?:[aeiouy]++{_CONSONANT}++){{{COMPLEX_SYLLABLES - 1}}}+(?:[aiouy]|e(?! ))"
RUN = r" ([^ ]++)(?: \1(?= ))*+"


# Words that are never in the vocabulary.
_NO_VOCABULARY = (*VOCABULARY_STOPWORDS, *ascii_lowercase)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it.

    Naming it as a column would not do: a filter pushed below the projection
    puts the whole expression in place of the name, inside every lambda.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column | str) -> Column:
    """``text`` without white space at either end; bytes that are not UTF-8 are replaced.

    Only the ends are looked at: a pattern would be tried at every character.
    """
    return F.btrim(F.make_valid_utf8(text), F.lit(WS_CHARS))


def is_blank(text: Column | str) -> Column:
    return ~F.rlike(text, F.lit(NON_BLANK))


def letter_tokens(text: Column | str, min_length: int = 2) -> Column:
    """Runs of a-z in the lower-cased text; shorter runs are left out by the pattern."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[a-z]{{{min_length},}}"), F.lit(0))


def is_content(word: Column | str) -> Column:
    """True for a letter token that is no stopword."""
    word = F.col(word) if isinstance(word, str) else word
    return ~word.isin(FREQUENCY_STOPWORDS)


def words(text: Column | str) -> Column:
    """Lower-cased words with inner apostrophes."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def vocabulary(runs: Column | str) -> Column:
    """The content words among word runs."""
    return content_words(F.transform(runs, lambda r: r["word"]))


def content_words(words: Column) -> Column:
    """The distinct words of two letters or more that are no stopwords."""
    return F.array_except(words, F.array(*map(F.lit, _NO_VOCABULARY)))


def is_vocabulary(word: Column | str) -> Column:
    """True for a word that ``content_words`` keeps."""
    word = F.col(word) if isinstance(word, str) else word
    return ~word.isin(*_NO_VOCABULARY)


def word_runs(tokens: Column) -> Column:
    """``array<struct<word, n>>``: each distinct token in word order with its count.

    Counts within one row, so nothing is shuffled: in the sorted tokens, put in a
    line, equal ones are neighbours, and one pattern finds each run of them. Tokens
    hold no space.
    """
    runs = F.regexp_extract_all(line_of(F.sort_array(tokens)), F.lit(RUN), F.lit(0))

    def run_of(run: Column) -> Column:
        word = F.substring_index(run, " ", -1)
        # each of the n equal words of a run has its space
        return F.struct(word.alias("word"), (F.octet_length(run) / (F.octet_length(word) + 1)).cast("bigint").alias("n"))

    return F.transform(runs, run_of)


def line_of(tokens: Column) -> Column:
    """The tokens as a line with a space before, between and after them."""
    return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))


def total(runs: Column | str, value: Callable[[Column], Column]) -> Column:
    """Sum of ``value`` over runs."""
    return F.aggregate(runs, F.lit(0).cast("bigint"), lambda sum_, r: sum_ + value(r))


def syllables(word: Column | str) -> Column:
    """Estimated syllables of a lower-case word: vowel groups, a final silent e aside."""
    word = F.col(word) if isinstance(word, str) else word
    silent = (F.length(word) > 2) & F.endswith(word, F.lit("e"))
    spoken = F.when(silent, F.left(word, F.length(word) - 1)).otherwise(word)
    groups = F.regexp_count(spoken, F.lit("[aeiouy]+"))
    return F.when(word == "", 0).otherwise(F.greatest(F.lit(1), groups))


def bare_word(text: Column | str) -> Column:
    """Lower-cased text without punctuation at either end, ready for ``syllables``."""
    return F.regexp_replace(F.lower(text), r"^\p{Punct}+|\p{Punct}+$", "")


def sentences(text: Column | str) -> Column:
    """Sentences of each line, stripped; abbreviations do not end one."""
    guarded = F.col(text) if isinstance(text, str) else text
    for short in ABBREVIATIONS:
        guarded = F.replace(guarded, F.lit(short), F.lit(short.replace(".", "\u0001")))
    pieces = F.filter(F.split(guarded, SENTENCE_END, -1), lambda s: F.rlike(s, F.lit(NON_BLANK)))
    return F.transform(pieces, lambda s: F.replace(strip(s), F.lit("\u0001"), F.lit(".")))


def sentence_count(text: Column | str) -> Column:
    """The size of ``sentences``, from one scan that keeps no sentence.

    Between line ends, each sentence that is not blank stands between two matches.
    """
    text = F.col(text) if isinstance(text, str) else text
    return (F.regexp_count(F.concat(F.lit("\n"), text, F.lit("\n")), F.lit(SENTENCE_GAP)) - 1).cast("bigint")


def syllables_of_line(line: Column) -> Column:
    """Sum of ``syllables`` over the words of a line as ``line_of`` gives it."""
    vowels, silent, none = (F.regexp_count(line, F.lit(p)) for p in (VOWELS, SILENT, NO_VOWEL))
    return vowels.cast("bigint") - silent + none


def complex_words_of_line(line: Column) -> Column:
    """Number of words of ``COMPLEX_SYLLABLES`` or more in a line as ``line_of`` gives it."""
    return F.regexp_count(line, F.lit(COMPLEX)).cast("bigint")
