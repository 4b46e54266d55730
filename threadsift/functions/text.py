"""Mail body cleaning as one native column expression.

The rule set, applied to the whole body:

1. A body that looks like HTML ('<' together with '</' or '/>') is reduced to its
   text: only what is inside <body> when there is one; comments, scripts, styles
   and images dropped; white space collapsed; headings in upper case; list items
   start with ' * '; links keep their target in brackets unless it equals the link
   text; block elements and <br> become line breaks; named and numeric entities decoded.
   Structure that depends on what is open is followed by a walk over the tags: items of
   <ol> start with their number (from `start`, each list on its own, nested or not), a
   table row is a line and its cells stand one space apart, and every line inside a
   <blockquote> starts with one '> ' for each open one. Closing tags without an opening
   one are passed over; what is left open ends with the text.
2. What the sender did not write is dropped, unless nothing would remain:
   - quoted lines ('>'), so HTML quotes of any depth too;
   - attribution lines: 'On ... wrote:', and with a digit in them 'Le ... a écrit :',
     'Am ... schrieb ...:', 'El ... escribió:', each over one line or two;
   - header blocks of a quoted message: a line 'From:' ('De :', 'Von:', 'De:') with two more
     header lines at least behind it, and 'Original Message' or 'Forwarded message' rules.
     The text of the message below such a block stays: it may be what was forwarded;
   - signatures. The text is a list of fragments with blank lines between them. They are
     walked from the last one upwards as long as nothing visible was met: a line '--', '__',
     'Sent from my ...' (or its form in the other languages) ends a fragment there, and a
     fragment that starts with it goes. Above the first visible fragment all stays.
3. Line endings and white space are normalised.
4. Text over the limit is cut and marked.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.functions.scalars import bound, scan, trim_blank

# Entities by name; numeric ones ('&#8364;', '&#x20AC;') are decoded by their number.
ENTITIES = {
    "nbsp": " ",
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "copy": "©",
    "reg": "®",
    "trade": "™",
    "middot": "·",
    "bull": "•",
    "hellip": "…",
    "ndash": "–",
    "mdash": "—",
    "lsquo": "‘",
    "rsquo": "’",
    "ldquo": "“",
    "rdquo": "”",
    "euro": "€",
    "pound": "£",
    "amp": "&",
}

# Invisible marks around a heading while its text is put in upper case.
_HEADING_OPEN = "\x01"
_HEADING_CLOSE = "\x02"

# Invisible marks: a quote opens and closes, and a space that must stay.
_QUOTE_OPEN = "\x05"
_QUOTE_CLOSE = "\x06"
_HARD_SPACE = "\x07"
_TAG_START = "\x03"
_TAG_END = "\x04"
_STRUCTURE = r"(?i)(</?(?:blockquote|ol|ul|li|table|tr|td|th)\b[^>]*>)"
_STRUCTURED = r"(?i)<(?:/?blockquote|ol|t[dh])\b"

_HTML_STEPS = (
    (r"(?is)^.*?<body\b[^>]*>", ""),
    (r"(?is)</body\b.*$", ""),
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", ""),
    (r"[\t\n\x0B\f\r]\s*| \s+", " "),
    (r"(?i)<a\b[^>]*?\bhref=\"([^\"]*)\"[^>]*>\1</a\s*>", "$1"),
    (r"(?i)<a\b[^>]*?\bhref=\"([^\"]*)\"[^>]*>(.*?)</a\s*>", "$2 [$1]"),
    (r"(?i)<h[1-6]\b[^>]*>", "\n\n" + _HEADING_OPEN),
    (r"(?i)</h[1-6]\s*>", _HEADING_CLOSE + "\n\n"),
)

_LINE_STEPS = (
    (r"(?i)<li\b[^>]*>", "\n * "),
    (r"(?i)<br\b[^>]*>|</?(div|tr|nav|section|article|header|footer|main|aside|address|form|hr)\b[^>]*>|</li\s*>", "\n"),
    (r"(?i)</?(p|ul|ol|table|blockquote|pre)\b[^>]*>", "\n\n"),
    (r"</?[A-Za-z!][^>]*>", ""),
    (r"\n +([^* ])", "\n$1"),
    (r" +\n", "\n"),
)


def looks_like_html(text: Column) -> Column:
    return text.contains("<") & (text.contains("</") | text.contains("/>"))


def _upper_headings(text: Column) -> Column:
    def piece(part: Column) -> Column:
        title = F.substring_index(part, _HEADING_CLOSE, 1)
        rest = F.substring(part, F.length(title) + 2, F.length(part))
        return F.when(part.contains(_HEADING_CLOSE), F.concat(F.upper(title), rest)).otherwise(part)

    return F.array_join(F.transform(F.split(text, _HEADING_OPEN), piece), "")


def _structure_step(state: Column, piece: Column) -> tuple[Column, Column]:
    """A structural tag and the text behind it -> the text that stands for both.

    The state: `lists`, the next number of every open <ol>, -1 for a <ul>; `cells`, the cells
    so far in the row of every open <table>; `quotes`, the open quotes.
    """
    tag = F.lower(F.regexp_extract(piece, r"^<(/?[A-Za-z]+)", 1))
    rest = F.substring_index(piece, _TAG_END, -1)
    lists, cells, quotes = state["lists"], state["cells"], state["quotes"]
    in_list, in_table = F.size(lists) > 0, F.size(cells) > 0

    def top(stack: Column) -> Column:
        return F.get(stack, F.size(stack) - 1)

    def popped(stack: Column) -> Column:
        return F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))

    def with_top(stack: Column, value: Column) -> Column:
        return F.concat(popped(stack), F.array(value))

    given = F.regexp_extract(F.substring_index(piece, _TAG_END, 1), r"(?i)\bstart\s*=\s*[\"']?(\d{1,9})", 1)
    first = F.coalesce(F.nullif(given, F.lit("")).try_cast("int"), F.lit(1))
    numbered = in_list & (top(lists) >= 0)
    next_lists = (
        F.when(tag == "ol", F.concat(lists, F.array(first)))
        .when(tag == "ul", F.concat(lists, F.array(F.lit(-1))))
        .when(tag.isin("/ol", "/ul"), popped(lists))
        .when((tag == "li") & numbered, with_top(lists, top(lists) + 1))
        .otherwise(lists)
    )
    is_cell = tag.isin("td", "th")
    next_cells = (
        F.when(tag == "table", F.concat(cells, F.array(F.lit(0))))
        .when(tag == "/table", popped(cells))
        .when((tag == "tr") & in_table, with_top(cells, F.lit(0)))
        .when(is_cell & in_table, with_top(cells, top(cells) + 1))
        .otherwise(cells)
    )
    next_quotes = (
        F.when(tag == "blockquote", quotes + 1)
        .when(tag == "/blockquote", F.greatest(quotes - 1, F.lit(0)))
        .otherwise(quotes)
    )
    space, line, gap = F.lit(_HARD_SPACE), F.lit("\n"), F.lit("\n\n")
    shown = (
        F.when(tag == "blockquote", F.lit("\n\n" + _QUOTE_OPEN))
        .when(tag == "/blockquote", F.when(quotes > 0, F.lit(_QUOTE_CLOSE + "\n\n")).otherwise(""))
        .when((tag == "li") & numbered, F.concat(line, space, top(lists).cast("string"), F.lit(". ")))
        .when(tag == "li", F.lit("\n * "))
        .when(tag.isin("/li", "tr", "/tr"), line)
        .when(is_cell, F.when(in_table & (top(cells) > 0), F.lit(" ")).otherwise(""))
        .when(tag.isin("ol", "ul"), F.when(in_list, F.lit("")).otherwise(gap))
        .when(tag.isin("/ol", "/ul"), F.when(F.size(lists) > 1, line).otherwise(gap))
        .when(tag.isin("table", "/table"), gap)
        .otherwise("")
    )
    following = F.struct(next_lists.alias("lists"), next_cells.alias("cells"), next_quotes.alias("quotes"))
    return following, F.concat(shown, rest)


def _structured(text: Column) -> Column:
    """Lists, tables and quotes as text, where a text has what depends on nesting."""
    marked = F.regexp_replace(text, _STRUCTURE, f"{_TAG_START}$1{_TAG_END}")
    start = F.struct(
        F.array().cast("array<int>").alias("lists"), F.array().cast("array<int>").alias("cells"), F.lit(0).alias("quotes")
    )
    walked = bound(F.split(marked, _TAG_START), lambda pieces: F.array_join(scan(pieces, start, _structure_step, "string"), ""))
    return F.when(text.rlike(_STRUCTURED), walked).otherwise(text)


def _quote_step(depth: Column, line: Column) -> tuple[Column, Column]:
    opened = F.length(line) - F.length(F.replace(line, F.lit(_QUOTE_OPEN), F.lit("")))
    closed = F.length(line) - F.length(F.replace(line, F.lit(_QUOTE_CLOSE), F.lit("")))
    bare = F.translate(line, _QUOTE_OPEN + _QUOTE_CLOSE, "")
    return depth + opened - closed, F.rtrim(F.concat(F.repeat(F.lit("> "), depth + opened), bare))


def _with_quote_marks(text: Column) -> Column:
    """One '> ' for each open quote in front of every line; a quote starts and ends with a line of text."""
    close = F.regexp_replace(F.regexp_replace(text, _QUOTE_OPEN + r"\s+", _QUOTE_OPEN), r"\s+" + _QUOTE_CLOSE, _QUOTE_CLOSE)
    lines = bound(F.split(close, "\n"), lambda parts: F.array_join(scan(parts, F.lit(0), _quote_step, "string"), "\n"))
    return F.when(text.contains(_QUOTE_OPEN), lines).otherwise(text)


def html_to_text(html: Column) -> Column:
    text = html
    for pattern, replacement in _HTML_STEPS:
        text = F.regexp_replace(text, pattern, replacement)
    text = bound(text, _structured)
    for pattern, replacement in _LINE_STEPS:
        text = F.regexp_replace(text, pattern, replacement)
    text = bound(bound(_upper_headings(text), _decoded), _with_quote_marks)
    return trim_blank(bound(text, lambda t: F.when(t.contains(_HARD_SPACE), F.replace(t, F.lit(_HARD_SPACE), F.lit(" "))).otherwise(t)))


def _numeric_entity(code: Column) -> Column:
    """Character of '#123' or '#x1F'; NULL for anything else."""
    decimal = F.when(code.rlike("^#[0-9]{1,7}$"), F.substring(code, 2, 7))
    hexadecimal = F.when(code.rlike("^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substring(code, 3, 6), 16, 10))
    number = F.coalesce(decimal, hexadecimal).try_cast("int")
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def _decoded(text: Column) -> Column:
    """Entities decoded in one pass: the text is cut at '&' and each piece looks up its name."""
    pairs = [F.lit(part) for entity in ENTITIES.items() for part in entity]
    table = F.create_map(*pairs)

    def piece(part: Column, index: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        character = F.coalesce(F.try_element_at(table, name), _numeric_entity(name))
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        decoded = F.when(part.contains(";"), F.concat(character, rest))
        return F.when(index == 0, part).otherwise(F.coalesce(decoded, F.concat(F.lit("&"), part)))

    joined = F.array_join(F.transform(F.split(text, "&"), piece), "")
    return F.when(text.contains("&"), joined).otherwise(text)


# Each step with the plain strings of which a text must hold one for the step to matter:
# a search for a string is far cheaper than running the pattern.
_SECOND_LINE = r"[^\n]*(?:\n[^\n]*)?"
_HEADER = r"(?:From|Sent|Date|To|Cc|Subject|De|Envoyé|À|Objet|Von|Gesendet|Datum|An|Betreff|Enviado(?: el)?|Fecha|Para|Asunto) ?:[^\n]*"
_QUOTE_STEPS = ((r"(?dm)^>[^\n]*\n?", "", (">",)),)
# None of these is there without a colon, except rules of dashes.
_COLON_STEPS = (
    (rf"(?dm)^On {_SECOND_LINE}wrote:[ \t]*$", "", ("wrote:",)),
    (rf"(?dm)^Le (?=[^\n]*\d){_SECOND_LINE}a écrit[ \u00a0\u202f]?:[ \t]*$", "", ("a écrit",)),
    (rf"(?dm)^Am (?=[^\n]*\d){_SECOND_LINE}schrieb[^\n]*:[ \t]*$", "", ("schrieb",)),
    (rf"(?dm)^El (?=[^\n]*\d){_SECOND_LINE}escribió:[ \t]*$", "", ("escribió:",)),
    (
        r"(?dm)^-{2,} ?(?:Original Message|Forwarded message|Message d'origine|Message transféré|Ursprüngliche Nachricht"
        r"|Weitergeleitete Nachricht|Mensaje original|Mensaje reenviado) ?-{2,}[ \t]*$",
        "",
        ("--",),
    ),
    (rf"(?dm)^(?:From|De|Von) ?:[^\n]*(?:\n{_HEADER}){{2,}}+$", "", ("From:", "De:", "De :", "Von:")),
)

_SIGNATURE = (
    r"(?ds)(?:\A|\n)(?:--|__|Sent from my [^\n]*|Get Outlook for [^\n]*|Envoyé de mon [^\n]*|Envoyé depuis mon [^\n]*"
    r"|Von meinem [^\n]* gesendet|Enviado desde mi [^\n]*)[ \t]*(?:\n.*)?\z"
)
_SIGNATURE_MARKS = ("--", "__", "Sent from my ", "Get Outlook for ", "Env", "Von meinem ")

_SPACE_STEPS = (
    (r"\n{3,}", "\n\n", ("\n\n\n",)),
    (r"[ \t]{2,}", " ", ("  ", "\t")),
    # White space at the very start is trimmed in the end, so only later lines count.
    (r"(?dm)^\s+$", "", ("\n ", "\n\t", "\r", "\f", "\v")),
)


def _apply(text: Column, steps) -> Column:
    for pattern, replacement, marks in steps:
        text = bound(text, _guarded(pattern, replacement, marks))
    return text


def _guarded(pattern: str, replacement: str, marks: tuple[str, ...]):
    def step(text: Column) -> Column:
        present = reduce(or_, (text.contains(mark) for mark in marks))
        return F.when(present, F.regexp_replace(text, pattern, replacement)).otherwise(text)

    return step


def _fragment_step(seen: Column, fragment: Column) -> tuple[Column, Column]:
    """`seen`: something visible stands below. Until then a fragment loses its signature."""
    left = F.when(seen, fragment).otherwise(F.regexp_replace(fragment, _SIGNATURE, ""))
    return seen | (trim_blank(left) != ""), left


def without_signature(text: Column) -> Column:
    """The text without the signatures that end it, fragment by fragment from the last one upwards."""
    fragments = F.reverse(F.split(text, r"\n(?:[ \t\r\f\x0B]*\n)+"))
    kept = bound(fragments, lambda f: scan(f, F.lit(False), _fragment_step, "string"))
    shown = F.filter(F.reverse(kept), lambda f: trim_blank(f) != "")
    present = reduce(or_, (text.contains(mark) for mark in _SIGNATURE_MARKS))
    return F.when(present, F.array_join(shown, "\n\n")).otherwise(text)


def without_quotes(text: Column) -> Column:
    def attributed(unquoted: Column) -> Column:
        return F.when(unquoted.contains(":") | unquoted.contains("--"), _apply(unquoted, _COLON_STEPS)).otherwise(unquoted)

    return bound(bound(_apply(text, _QUOTE_STEPS), attributed), without_signature)


def clean_body(body: Column, max_chars: int = fixed.BODY_MAX_CHARS) -> Column:
    """Plain, cleaned and truncated text of a mail body; '' for NULL."""
    unix = F.replace(F.coalesce(body, F.lit("")), F.lit("\r\n"), F.lit("\n"))

    def visible_part(text: Column) -> Column:
        return bound(without_quotes(text), lambda v: F.when(trim_blank(v) != "", v).otherwise(text))

    def spaced(text: Column) -> Column:
        return trim_blank(_apply(text, _SPACE_STEPS))

    def truncated(text: Column) -> Column:
        return F.when(
            F.length(text) > max_chars,
            F.concat(F.substring(text, 1, max_chars), F.lit(fixed.TRUNCATION_MARK)),
        ).otherwise(text)

    plain = bound(unix, lambda t: F.when(looks_like_html(t), html_to_text(t)).otherwise(t))
    return bound(bound(plain, lambda t: spaced(visible_part(t))), truncated)
