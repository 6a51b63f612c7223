"""Tokenising expressions that run inside the JVM.

The rules follow ``String.split("\\s+")`` and ``String.trim()`` of Java, because word counts
depend on them: a leading blank yields one empty token, trailing blanks yield none, an
empty line is one empty token, and a line of blanks only has no token.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What the regex class \s matches, the English stop words of Spark ML, and what
# trim() strips (U+0000 - U+0020).
WHITESPACE = " \t\n\x0b\f\r"
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split()
TRIMMED = "".join(chr(code) for code in range(0x21))


def strip(column: Column) -> Column:
    """Remove control characters and blanks at both ends."""
    return F.trim(column, F.lit(TRIMMED))


def _blank(line: Column) -> Column:
    return (line != "") & (F.rtrim(line, F.lit(WHITESPACE)) == "")


def tokens(line: Column) -> Column:
    """Lower-case tokens between runs of white space; NULL for a line of blanks."""
    body = F.rtrim(F.lower(line), F.lit(WHITESPACE))
    return F.when(~_blank(line), F.split(body, r"\s+"))


def clean(word: Column) -> Column:
    """Lower-case the word and keep only the letters a-z; accented letters are removed."""
    return F.regexp_replace(F.lower(word), "[^a-z]", "")


def clean_line(line: Column) -> Column:
    """All tokens of a line cleaned and joined by single spaces.

    A token without letters stays in its place as an empty token, so it shows up as two
    spaces in a row. Cleaning the line at once is two regex passes instead of one call
    per token.
    """
    body = F.regexp_replace(F.rtrim(F.lower(line), F.lit(WHITESPACE)), r"\s+", " ")
    return F.when(~_blank(line), F.regexp_replace(body, "[^a-z ]", ""))


def clean_tokens(line: Column) -> Column:
    """Cleaned tokens of a line, empty ones included."""
    return F.split(clean_line(line), " ")


def ngrams(line: Column, n: int, empty_token: str | None = None) -> Column:
    """The n-grams of the cleaned tokens of one line, as an array of strings.

    An n-gram that would hold an empty token is left out. With ``empty_token`` such
    tokens are kept under that name instead, e.g. ``"null"``.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    body = clean_line(line)
    if empty_token is not None:
        if not (empty_token.isascii() and empty_token.isalpha() and empty_token.islower()):
            raise ValueError("empty_token must consist of letters a-z")
        body = F.regexp_replace(body, "(?<=^| )(?= |$)", empty_token)
    if n == 1:
        return F.array_remove(F.split(body, " "), "")
    # A zero-width match at every token start; the n-gram is captured ahead of it, so
    # matches may overlap. A single space between letters means: no empty token between.
    window = "(?<![a-z])(?=([a-z]+(?: [a-z]+){%d})(?![a-z]))" % (n - 1)
    return F.regexp_extract_all(body, F.lit(window), F.lit(1))
