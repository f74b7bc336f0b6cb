import random

from prosestat.constants import FREQUENCY_STOPWORDS, VOCABULARY_STOPWORDS
from prosestat.functions import numbers, paths, text

TRICKY = "naïve _it_ it's dogs' 'tis x1"


def test_word_lists():
    assert len(set(FREQUENCY_STOPWORDS)) == 73 and len(set(VOCABULARY_STOPWORDS)) == 68
    only_first = set(FREQUENCY_STOPWORDS) - set(VOCABULARY_STOPWORDS)
    assert only_first == {"though", "what", "when", "where", "which", "while", "who"}
    assert set(VOCABULARY_STOPWORDS) - set(FREQUENCY_STOPWORDS) == {"neither", "up"}


def test_two_vocabularies(evaluate):
    assert evaluate([TRICKY], text.words) == [["it's", "dogs", "tis"]]
    assert evaluate([TRICKY], lambda c: text.letter_tokens(c, 1)) == [
        ["na", "ve", "it", "it", "s", "dogs", "tis", "x"]]
    assert evaluate([TRICKY], text.letter_tokens) == [["na", "ve", "it", "it", "dogs", "tis"]]
    assert evaluate(["Bring 7 ropes", ""], text.words) == [["bring", "ropes"], []]


def _words_by_scan(line):
    """Cut at everything that is neither a word character nor an apostrophe, then
    keep from each cut the letter stretches whose neighbours are not word characters."""
    line, found, i = line.lower(), [], 0
    is_word = lambda c: c.isalnum() or c == "_"
    while i < len(line):
        if "a" <= line[i] <= "z" and (i == 0 or not is_word(line[i - 1])):
            ends = [j for j in range(i + 1, len(line) + 1)
                    if all("a" <= c <= "z" or c == "'" for c in line[i:j])
                    and line[j - 1] != "'" and (j == len(line) or not is_word(line[j]))]
            if ends:
                found.append(line[i:ends[-1]])
                i = ends[-1]
                continue
        i += 1
    return found


def test_words_against_brute_force(evaluate):
    rng = random.Random(7)
    lines = ["".join(rng.choice("abE''é_1 .-") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    assert evaluate(lines, text.words) == [_words_by_scan(line) for line in lines]


SYLLABLES = [
    ("cat", 1), ("happy", 2), ("beautiful", 3), ("make", 1), ("rain", 1), ("", 0), ("the", 1),
    ("me", 1), ("e", 1), ("hmm", 1), ("free", 1), ("question", 2)]


def test_syllables(evaluate):
    assert list(zip([w for w, _ in SYLLABLES], evaluate([w for w, _ in SYLLABLES], text.syllables))) == SYLLABLES


def test_bare_word(evaluate):
    assert evaluate(["Happy!", "...", "'Rain,"], text.bare_word) == ["happy", "", "rain"]


SENTENCES = [
    ("Dr. Hale rode to Lynn. Snow fell.", 2), ("It rang.  It rang twice.", 2),
    ("no end mark", 1), ("", 0), ("   ", 0), ("...", 0), ("What?! Yes... no", 3),
    ("two lines\nwithout marks", 2), ("ends here.\r\nnext", 2), ("a.b is one", 1),
    ("e.g. U.S. and U.K. etc. stay", 1), ("ends.\n\n\nagain", 2), ("x. \u00a0", 1)]


def test_sentence_count(evaluate):
    lines = [line for line, _ in SENTENCES]
    assert list(zip(lines, evaluate(lines, text.sentence_count))) == SENTENCES
    assert list(zip(lines, map(len, evaluate(lines, text.sentences)))) == SENTENCES


def test_sentences_keep_abbreviations(evaluate):
    assert evaluate(["Mr. X came. He left!"], text.sentences) == [["Mr. X came", "He left"]]


def test_whole_text_equals_sum_of_lines(evaluate):
    rng = random.Random(3)
    whole = ["".join(rng.choice("ab e.!? \n\r'") for _ in range(40)) for _ in range(150)]
    lines = [piece for t in whole for piece in t.split("\n")]
    by_line = iter(evaluate(lines, text.sentence_count))
    expected = [sum(next(by_line) for _ in t.split("\n")) for t in whole]
    assert evaluate(whole, text.sentence_count) == expected


def test_strip_and_blank(evaluate):
    odd = ["\u00a0 a b\t\r", "\x1c", ""]
    assert evaluate(odd, text.strip) == ["a b", "", ""]
    assert evaluate(odd, text.is_blank) == [False, True, True]


def test_vocabulary(evaluate):
    assert evaluate(["The fox and a fox, up I x"], lambda c: text.vocabulary(text.word_runs(text.words(c)))) == [["fox"]]


def test_word_runs(evaluate):
    got = evaluate(["b a b c b", ""], lambda c: text.word_runs(text.words(c)))
    assert [[tuple(r) for r in runs] for runs in got] == [[("a", 1), ("b", 3), ("c", 1)], []]


def test_numbers(evaluate):
    values = ["5", "+5", " -5 ", "1_000", "5.0", "x", "", "_1", "1__0", "99999999999999999999"]
    assert evaluate(values, numbers.as_int) == [5, 5, -5, 1000, None, None, None, None, None, None]
    values = ["5", ".5", "5.", "1e3", " 1_0.5 ", "-inf", "Infinity", "5d", "0x1p3", "five", ""]
    assert evaluate(values, numbers.as_float) == [
        5.0, 0.5, 5.0, 1000.0, 10.5, float("-inf"), float("inf"), None, None, None, None]
    assert str(evaluate(["-nan"], numbers.as_float)[0]) == "nan"


def test_paths(evaluate):
    where = ["/output/word-freq/part-00000", "/output/comp2/x", "/output/syntax/x", "/data/metadata/b.csv",
             "/output/misc/x", "/OUT/WordFreq/x", "/comp3/wordfreq/x", "/sentiment/meta.csv"]
    assert evaluate(where, paths.path_component) == [
        "wordfreq", "sentiment", "syntactic", "metadata", "unknown", "wordfreq", "wordfreq", "sentiment"]
    where = ["/output/wordfreq/5107/part-00000", "/o/5107_output.txt", "/o/part-output", "C:\\b\\61\\x",
             "5107.txt", "61_marsh_letters.txt", "my book.txt"]
    assert evaluate(where, paths.path_book_id) == ["5107", "5107", "unknown", "61", "5107", "61", "unknown"]
    where = ["/b/5107.txt", "61_marsh_letters.txt", "my  book.txt", ".txt", "a.b.txt", "/x/", "a..txt"]
    assert evaluate(where, paths.stem_book_id) == [
        "5107", "61_marsh_letters", "my_book", ".txt", "a.b", "unknown", "a."]
