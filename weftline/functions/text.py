"""Text rules as Column expressions. All are JVM-side: regular expressions and string functions, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that trimming removes, as a character class body, and what comparison drops besides.
WHITE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
ASCII_MARKS = r"!-/:-@\[-`{-~"
WIDE_MARKS = "，。：；！？（）【】“”‘’、"
SEPARATORS = rf"{WHITE},.;:()\[\]{{}}，。；：（）【】"
EXPERT_LEAD = "You are a very talented expert in "
#: The same characters one by one, for what is done without patterns.
WHITE_CHARACTERS = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
ASCII_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PYTHON_WHITE = WHITE + r"\x{1C}-\x{1F}"


def _ends(white: str) -> str:
    """A run at the start or the end; a run elsewhere is looked at once, however long it is."""
    return rf"\A[{white}]++|(?<![{white}])[{white}]++\z"


def trim(c: Column) -> Column:
    """Without white space at both ends (Unicode white space, unlike Spark's own trim)."""
    return F.regexp_replace(c, _ends(WHITE), "")


def strip(c: Column) -> Column:
    """As ``trim``, and the four information separators too; null gives ''."""
    return F.coalesce(F.regexp_replace(c, _ends(PYTHON_WHITE), ""), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def unescape(c: Column) -> Column:
    r"""Decode \n \r \t \\ \" \/ in one pass; other backslashes stay. Between two escaped backslashes no escape can reach over."""
    def plain(part: Column) -> Column:
        for code, char in (("n", "\n"), ("r", "\r"), ("t", "\t"), ('"', '"'), ("/", "/")):
            part = F.replace(part, F.lit("\\" + code), F.lit(char))
        return part

    parts = F.array_join(F.transform(F.split(c, r"\\\\", -1), plain), "\\")
    return F.when(F.contains(c, F.lit("\\\\")), parts).otherwise(plain(c))


def count_of(c: Column, piece: str) -> Column:
    """Occurrences of a piece of text that cannot overlap itself."""
    return (F.length(c) - F.length(F.replace(c, F.lit(piece), F.lit("")))) / len(piece)


def single_turn(c: Column) -> Column:
    """The user's part of a text with one line-start ``User:`` (its first) and one ``Assistant:``; else null."""
    led = F.concat(F.lit("\n"), trim(unescape(c)))
    one = led.startswith("\nUser:") & (count_of(led, "\nUser:") == 1) & (count_of(led, "\nAssistant:") == 1)
    return blank_to_null(F.when(one, trim(F.regexp_extract(led, r"(?s)\A\nUser:(.*?)\nAssistant:", 1))))


def prompt_user(c: Column) -> Column:
    """Single turn, or what stands between a leading ``User:`` and the first ``Assistant:`` line (or the end)."""
    led = trim(unescape(c))
    rest = F.regexp_extract(led, r"(?s)\AUser:(.*?)(?:\nAssistant:|\z)", 1)
    return F.coalesce(single_turn(c), blank_to_null(F.when(led.startswith("User:"), trim(rest))))


def sanitize(c: Column) -> Column:
    """Trimmed, without leading sentences that set up an expert."""
    return trim(F.regexp_replace(trim(c), rf"\A(?:{EXPERT_LEAD}[^.]*+\.[{WHITE}]*+)++", ""))


def norm(c: Column) -> Column:
    """For comparison: no white space, ASCII or wide marks; lower case character by character."""
    return F.lower(F.translate(c, "Σ" + WHITE_CHARACTERS + ASCII_SIGNS + WIDE_MARKS, "σ"))


def preview(c: Column, n: int) -> Column:
    t = trim(c)
    return F.when(F.length(t) <= n, t).otherwise(F.concat(F.substring(t, 1, n), F.lit("...")))


def task_id(sample_id: Column, index: Column) -> Column:
    return F.format_string("%s_q%03d", sample_id, index)


def label(c: Column) -> Column:
    """The last token that is one letter, else the last letter that stands between no letters; upper case, or null."""
    inner = rf"[^A-Za-z0-9{SEPARATORS}]*"
    token = F.regexp_extract(c, rf"(?s)\A(?:.*[{SEPARATORS}])?{inner}([A-Za-z]){inner}(?:[{SEPARATORS}].*)?\z", 1)
    alone = F.regexp_extract(c, r"(?s)\A(?:.*[^A-Za-z])?([A-Za-z])(?:[^A-Za-z].*)?\z", 1)
    return F.upper(F.coalesce(blank_to_null(token), blank_to_null(alone)))


def last_line(c: Column) -> Column:
    """The last line that is not blank, trimmed; '' if there is none."""
    return trim(F.regexp_extract(trim(c), r"([^\n]*)\z", 1))


def predicted(expected: Column, output: Column) -> Column:
    line = last_line(output)
    return F.when(label(expected).isNotNull(), F.coalesce(label(trim(output)), line)).otherwise(line)


def correct(expected: Column, output: Column) -> Column:
    wanted = label(expected)
    return F.when(wanted.isNotNull(), wanted.eqNullSafe(label(output))).otherwise(norm(expected) == norm(last_line(output)))


def same_answer(a: Column, b: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    fold = lambda c: F.translate(trim(c), upper, lower)
    return (fold(a) != "") & (fold(a) == fold(b))


def option_letter(answer: Column) -> Column:
    """A to D for an answer that is that letter alone, but for signs behind it; else null."""
    bare = trim(F.regexp_replace(trim(answer), r"[.)）]+\z", ""))
    return F.when(bare.rlike(r"\A[A-Da-d]\z"), F.upper(bare))


def option_text(user: Column, answer: Column) -> Column:
    """Text of the answer's option."""
    return option_at(user, option_letter(answer))


def option_at(user: Column, letter: Column) -> Column:
    """Text of an option: behind its first marker, up to the next marker of any option; null if blank."""
    found = None
    for one in "ABCD":
        pattern = rf"(?s)(?:\A|(?<=[{WHITE}:：]))[{one}{one.lower()}]\.(?=[{WHITE}])(.*?)(?=(?<=[{WHITE}:：])[A-Da-d]\.[{WHITE}]|\z)"
        this = letter == one
        text = F.regexp_extract(user, pattern, 1)
        found = F.when(this, text) if found is None else found.when(this, text)
    return blank_to_null(trim(found))


def reuses_reference(source: Column, user: Column, answer: Column, reference: Column) -> Column:
    """Whether an answer repeats the reference answer's content; a blank reference never does."""
    return same_answer(answer, reference) & repeats_option(option_text(source, reference), option_text(user, answer), reference)


def repeats_option(a: Column, b: Column, reference: Column) -> Column:
    """Whether two options are alike, as far as both are there; a blank reference has none."""
    same = F.when(a.isNotNull() & b.isNotNull(), norm(a) == norm(b)).otherwise(True)
    return (F.coalesce(trim(reference), F.lit("")) != "") & same


def merged_output(reasoning: Column, content: Column) -> Column:
    """Reasoning in a think block before the content; null reasoning gives the content alone."""
    think = F.concat(F.lit("<think>\n"), trim(reasoning), F.lit("\n</think>"))
    body = trim(content)
    return F.when(reasoning.isNull(), body).when(body == "", think).otherwise(F.concat(think, F.lit("\n\n"), body))


def training_text(user: Column, output: Column) -> Column:
    return F.concat(F.lit("User: "), trim(user), F.lit("\nAssistant: "), trim(output))


def think_block(output: Column) -> Column:
    """The first think block, to its end or the text's, inner text stripped; '' without one."""
    t = strip(output)
    inner = strip(F.regexp_extract(t, r"(?s)<think>(.*?)(?:</think>|\z)", 1))
    block = F.when(inner == "", "<think>\n</think>").otherwise(F.concat(F.lit("<think>\n"), inner, F.lit("\n</think>")))
    return F.when(F.contains(t, F.lit("<think>")), block).otherwise("")
