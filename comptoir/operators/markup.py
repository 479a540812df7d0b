"""Markup as columns: canonical tags, selectors, element contents.

``canonical`` brings every tag of a page to one written form (lower-case name,
double quotes, no ``>`` or ``"`` inside a value, no comments) and leaves text
alone. On that form a simple selector (tag, ``#id``, ``.class``, attribute
tests) is a pattern of the opening tag in which attributes and classes may
stand in any order among others, and a selector with several parts is looked
up part by part inside the contents of the elements before. An element ends
at the closing tag that balances it; nested elements of its kind are inside.

All of it are expressions over one page's text: no shuffle, no Python, and
each pattern passes over the text once.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col, let
from ..functions.text import strip_ws

# Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

# Entities decoded in extracted text (as an HTML parser does).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&pound;", "£"),
            ("&euro;", "€"), ("&amp;", "&")]

BLANKS = r" \t\n\x0B\f\r"  # \s as single characters: a class of these only is one table look-up
TAG = r"<[^>]+>"
COMMENT = r"(?s)<!--.*?-->"
# Signs of tags in another form than the canonical one, each a cheap scan: a value in single quotes or after blanks, a
# bare value, a name in upper case; a '>' in a value; a double quote in a single-quoted value.
LOOSE = ("='", "= ", "=\n", "=\t", " =")
SPACED = ("\n=", "\t=", "\r=", "\f=", "\v=", "=\r", "=\f", "=\v")  # other blanks around '='
BARE = r"""\s[\w:.-]+=[^"'\s]"""
UPPER = "</?[A-Z]"
END_INSIDE = r"""="[^"<>]*>"""
QUOTE_INSIDE = r"""='[^'<]*["<>]"""
# An attribute of a tag: behind the tag's name, or behind the attribute before (and names without a value).
_ATTRIBUTES = r"""(?=[<\s])(<[a-zA-Z][\w:-]*|\G(?!^))(\s+[\w:.-]+(?:\s+[\w:.-]+)*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_OPENING = r"""^/?[a-zA-Z](?:[^"'>]++|"[^"]*+"|'[^']*+')*+>"""
_ATTRIBUTE = r"""([\w:.-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
# Content from the '>' of the opening tag to the end.
_TO_END = r"(>(?s:.*))"
ANY_NAME = r"[a-z][\w:-]*"
NESTED = r"[\s>\/]"  # behind a name: no longer name begins with it
NESTED_LEVELS = 8  # elements of one name inside one another that a pattern follows; deeper ones are counted piece by piece
_MARK = "\u0001"
_BEGIN, _END = "\u0003", "\u0004"  # around the tags found, while a page is cut at them
CONTROLS = "[\u0001\u0003\u0004]"  # dropped from pages, so that they can be used as marks
_EDGE = r"\A[^!-~]|[^!-~]\z"  # a blank at an end, or what may be one
# A whole page in canonical form without a '>' in its text. One pass tells what else takes a search for each sign above.
_PLAIN = (r"""\A[^<>MARKS]*(?:<(?:\/?[a-z][\w:-]*(?:[BLANKS]+[^BLANKS"'<>=\/MARKS]+(?:="[^"<>MARKS]*")?)*+[BLANKS]*\/?|![a-zA-Z][^<>"'=MARKS]*)>[^<>MARKS]*)*+\z"""
          .replace("MARKS", CONTROLS[1:-1]).replace("BLANKS", BLANKS))


def unescape(c) -> Column:
    """Decode the entities above."""
    def decoded(x: Column) -> Column:
        y = x
        for a, b in ENTITIES:
            y = F.replace(y, F.lit(a), F.lit(b))
        return F.when(x.contains("&"), y).otherwise(x)
    return F.when(F.col(c).contains("&"), let(F.col(c), decoded)).otherwise(F.col(c)) if isinstance(c, str) else let(c, decoded)


def inner_text(c) -> Column:
    """Text content of an HTML fragment: tags removed, entities decoded, stripped."""
    plain = let(as_col(c), lambda x: F.when(x.contains("<"), F.regexp_replace(x, TAG, "")).otherwise(x))
    return strip_ws(unescape(plain))


def _written(tag: Column) -> Column:
    """One tag (without its '<') in canonical form: values between marks first, so that quotes inside them can be told apart."""
    marked = F.regexp_replace(tag, _ATTRIBUTE, f"$1={_MARK}$2$3$4{_MARK}")
    # what is left of quotes and '>' but for the tag's own end is inside a value
    inside = F.replace(F.substring(marked, F.lit(1), F.length(marked) - 1), F.lit('"'), F.lit("&quot;"))
    inside = F.replace(F.replace(inside, F.lit(">"), F.lit("&gt;")), F.lit(_MARK), F.lit('"'))
    name = F.regexp_extract(inside, r"^/?[\w:-]+", 0)
    return F.concat(F.lower(name), F.substring(inside, F.length(name) + 1, F.length(inside)), F.lit(">"))


def _rewritten(page: Column) -> Column:
    """Every tag written anew, one by one: for pages that no replacement over the whole text can mend."""
    def piece(p: Column, i: Column) -> Column:
        tag = F.when(i > 0, F.regexp_substr(p, F.lit(_OPENING)))
        return let(tag, lambda t: F.when(t.isNull(), p).otherwise(F.concat(_written(t), F.substring(p, F.length(t) + 1, F.length(p)))))
    return F.array_join(F.transform(F.split(page, "<"), piece), "<")


def canonical(html) -> Column:
    """The page with comments dropped and every tag in canonical form. One pass tells pages that are in this form, and
    those that are after the quotes and blanks of attributes, and then a '>' in values, were mended by one replacement over
    the page each; of the others every sign is looked for, and what no replacement mends is written anew tag by tag."""
    def closed(q: Column) -> Column:
        return F.regexp_replace(q, END_INSIDE[:2] + '([^"<>]*)>', '="$1&gt;')

    def mended(c: Column, loose: Column) -> Column:
        spaced = loose
        for sign in SPACED:
            spaced = spaced | c.contains(sign)
        quoted = F.when(spaced, F.regexp_replace(c, _ATTRIBUTES, '$1$2="$3$4$5"')).otherwise(c)
        return let(quoted, lambda q: F.when(q.rlike(END_INSIDE), let(
            closed(q), lambda m: F.when(m.rlike(END_INSIDE), _rewritten(c)).otherwise(m))).otherwise(q))

    def checked(c: Column) -> Column:
        # a bare value needs a '=' that no double quote follows
        loose = F.replace(c, F.lit('="'), F.lit("")).contains("=") & c.rlike(BARE)
        for sign in LOOSE:
            loose = c.contains(sign) | loose
        # the pattern is only asked of pages that hold a single-quoted value
        quote_inside = c.contains(QUOTE_INSIDE[:2]) & c.rlike(QUOTE_INSIDE)
        return let(loose, lambda x: F.when(quote_inside | c.rlike(UPPER), _rewritten(c))
                   .when(x | c.rlike(END_INSIDE), mended(c, x)).otherwise(c))

    def quiet(c: Column) -> Column:
        noisy = c.contains(CONTROLS[1])
        for mark in CONTROLS[2:-1]:
            noisy = noisy | c.contains(mark)
        return F.when(noisy, F.regexp_replace(c, CONTROLS, "")).otherwise(c)

    def tried(c: Column) -> Column:
        even = F.regexp_replace(c, _ATTRIBUTES, '$1$2="$3$4$5"')
        quoted = (F.when(c.contains(QUOTE_INSIDE[:2]), F.when(~c.rlike(QUOTE_INSIDE), even))
                  .when(c.contains(LOOSE[-1]) | c.contains(LOOSE[1]), even).otherwise(c))
        return let(quoted, lambda q: F.when(q.rlike(_PLAIN), q).otherwise(let(
            closed(q), lambda m: F.when(m.rlike(_PLAIN), m).otherwise(let(quiet(c), checked)))))

    def written(h: Column) -> Column:
        bare = F.when(h.contains("<!--"), F.regexp_replace(h, f"{COMMENT}|{CONTROLS}", "")).otherwise(h)
        return F.when(h.rlike(_PLAIN), h).otherwise(let(bare, tried))

    return let(as_col(html), written)


# -- selectors ----------------------------------------------------------------


@dataclass(frozen=True)
class Simple:
    """One part of a selector: the element's name (None: any), the pattern of its opening tag in canonical form, and
    a text that every such tag holds (its longest; a search for it is much cheaper than the pattern)."""

    name: str | None
    pattern: str
    holds: str


_PART = re.compile(r"(?P<name>[a-zA-Z][\w-]*|\*)?(?P<tests>(?:#[\w-]+|\.[\w-]+|\[[^\]]+\])*)")
_TEST = re.compile(r"#([\w-]+)|\.([\w-]+)|\[\s*([\w:-]+)\s*(?:([~^$*|]?=)\s*(?:\"([^\"]*)\"|'([^']*)'|([^\]\s]+))\s*)?\]")


def _written_value(text: str) -> str:
    """``text`` as it stands in a canonical value."""
    return text.replace('"', "&quot;").replace(">", "&gt;")


def _escape(text: str) -> str:
    """The same as a literal pattern."""
    return re.escape(_written_value(text)).replace("/", r"\/")


def _holds(test: re.Match) -> str:
    ident, cls, attr, op, *values = test.groups()
    if ident is not None:
        return f'id="{_written_value(ident)}"'
    if cls is not None:
        return _written_value(cls)
    if op is None:
        return _written_value(attr)
    v = _written_value(next(x for x in values if x is not None))
    return {"=": f'{_written_value(attr)}="{v}"', "^=": f'{_written_value(attr)}="{v}', "$=": f'{v}"'}.get(op, v)


def _lookahead(test: re.Match) -> str:
    ident, cls, attr, op, *values = test.groups()
    if ident is not None:
        wanted = f'id="{_escape(ident)}"'
    elif cls is not None:
        wanted = rf'class="(?:[^"]*\s)?{_escape(cls)}[\s"]'
    elif op is None:
        wanted = rf"{_escape(attr)}[=\s>\/]"
    else:
        v = _escape(next(x for x in values if x is not None))
        value = {"=": v, "^=": rf'{v}[^"]*', "$=": rf'[^"]*{v}', "*=": rf'[^"]*{v}[^"]*', "~=": rf'(?:[^"]*\s)?{v}(?:\s[^"]*)?', "|=": rf'{v}(?:-[^"]*)?'}[op]
        wanted = rf'{_escape(attr)}="{value}"'
    # from blank to blank, instead of trying at every character
    return rf"(?=[^>{BLANKS}]*(?:\s(?!{wanted})[^>{BLANKS}]*)*+\s{wanted})"


def selector(text: str) -> list[Simple]:
    """A selector as its parts, outermost first. Parts are separated by blanks
    (descendants); other combinators and pseudo-classes raise ``ValueError``."""
    parts = re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", text.strip())
    out = []
    for p in parts:
        m = _PART.fullmatch(p)
        if m is None or not p:
            raise ValueError(f"selector {text!r}: {p!r} is not a tag, #id, .class or [attribute] test")
        name = m["name"].lower() if m["name"] and m["name"] != "*" else None
        tests = list(_TEST.finditer(m["tests"]))
        looks = "".join(map(_lookahead, tests))
        holds = max([*map(_holds, tests), f"<{name or ''}"], key=len)
        out.append(Simple(name, rf"<{name or ANY_NAME}(?=[\s>\/]){looks}[^>]*>", holds))
    if not out:
        raise ValueError("empty selector")
    return out


# -- elements --------------------------------------------------------------------


def _call(fn: str, *args: Column) -> Column:
    return F.call_function(fn, *args)


def _balanced(rest: Column, opening: Column, close: Column) -> Column:
    """Text up to the closing tag that balances the element whose opening tag comes before ``rest``."""
    # the first piece after which as many elements are closed as were opened
    state = F.struct(F.lit(1).alias("open"), F.lit(0).alias("at"))
    nested = F.concat(opening, F.lit(NESTED))

    def step(acc: Column, piece: Column) -> Column:
        return F.when(acc["open"] <= 0, acc).otherwise(
            F.struct((acc["open"] + F.regexp_count(piece, nested) - 1).alias("open"), (acc["at"] + 1).alias("at")))

    def joined(pieces: Column) -> Column:
        upto = F.aggregate(pieces, state, step, lambda s: s["at"])
        # a control character stands for the closing tags while pieces are joined
        return F.replace(F.array_join(F.slice(pieces, F.lit(1), upto), _BEGIN), F.lit(_BEGIN), close)

    return let(F.split(rest, close), joined)


def _ends(name: Column | str) -> tuple[Column, Column]:
    tag = F.lit(name) if isinstance(name, str) else name
    return F.concat(F.lit("<"), tag), F.concat(F.lit("</"), tag, F.lit(">"))


def element(rest: Column, name: Column | str) -> Column:
    """Content of an element from the text after its opening tag: up to the closing tag
    that balances it, nested elements of its kind included; all of ``rest`` when none does."""
    if isinstance(name, str) and name in VOID:
        return F.when(rest.isNotNull(), F.lit(""))
    opening, close = _ends(name)
    body = let(rest, lambda r: let(
        _call("substring_index", r, close, F.lit(1)), lambda s: F.when(~s.contains(opening), s).otherwise(_balanced(r, opening, close))))
    return body if isinstance(name, str) else F.when(name.isin(*VOID) & rest.isNotNull(), F.lit("")).otherwise(body)


def _name_of(tag: Column) -> Column:
    return F.regexp_extract(tag, r"^<([\w:-]+)", 1)


def elements(html: Column, part: Simple) -> Column:
    """array<struct<tag, body>> of all elements that match, in page order; nested ones too."""
    def one(pieces: Column, piece: Column, i: Column) -> Column:
        tag = F.substring_index(piece, _END, 1)

        def of(own: Column) -> Column:
            name = F.lit(part.name) if part.name else _name_of(tag)
            close = F.concat(F.lit("</"), name, F.lit(">"))
            head = _call("substring_index", own, close, F.lit(1))
            closed = own.contains(close) & ~head.contains(F.concat(F.lit("<"), name))
            # an element that is not closed before the next match holds it: its text is put together again
            rest = F.replace(F.array_join(F.slice(pieces, i + 2, F.size(pieces)), ""), F.lit(_END), F.lit(""))
            return F.when(closed, head).otherwise(element(F.concat(own, rest), part.name or name))
        return F.struct(tag.alias("tag"), let(F.substring_index(piece, _END, -1), of).alias("body"))

    def cut(marked: Column) -> Column:
        pieces = F.slice(F.split(marked, _BEGIN), 2, 1 << 30)
        return let(pieces, lambda p: F.transform(p, lambda x, i: one(p, x, i)))

    none = F.array().cast("array<struct<tag:string,body:string>>")
    def found(h: Column) -> Column:
        marked = F.when(h.contains(part.holds), F.regexp_replace(h, f"({part.pattern})", f"{_BEGIN}$1{_END}")).otherwise(h)
        return let(marked, lambda m: F.when(m.contains(_BEGIN), cut(m)).when(m.isNotNull(), none))
    return let(html, found)


def _found(text: Column, pattern: str) -> Column:
    """First match of a pattern that matches no empty text, or NULL. Unlike in ``regexp_substr``, ``text`` is evaluated
    once where no projection can hold it (inside a lambda)."""
    return let(F.regexp_extract(text, pattern, 0), lambda x: F.when(x != "", x))


def _scoped(html: Column, parts: list[Simple], find: Callable[[Column, Simple], Column]) -> Column:
    """``find`` of the last part inside the first elements of the parts before that hold it."""
    if len(parts) == 1:
        return find(html, parts[0])
    found = F.transform(elements(html, parts[0]), lambda e: _scoped(e["body"], parts[1:], find))
    return F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0))


def first_tag(html, sel: str) -> Column:
    """Opening tag of the first element that matches, or NULL."""
    return _scoped(as_col(html), selector(sel), lambda h, p: _found(h, p.pattern))


def first_body(html, sel: str) -> Column:
    """Content of the first element that matches, or NULL."""
    def find(h: Column, p: Simple) -> Column:
        def of(tag: Column) -> Column:
            rest = F.substring(h, F.instr(h, tag) + F.length(tag), F.length(h))
            return F.when(tag.isNotNull(), element(rest, p.name or _name_of(tag)))
        return let(_found(h, p.pattern), of)
    # the text is a whole expression of its own (a canonical page, another element): never computed for each use
    return _scoped(as_col(html), selector(sel), lambda h, p: let(h, lambda x: find(x, p)))


def first_text(html, sel: str) -> Column:
    """Text of the first element that matches, or NULL."""
    return inner_text(first_body(html, sel))


def _named(part: Simple) -> str:
    """The pattern of an opening tag; of one of any name, with the name as its first group."""
    return part.pattern if part.name else part.pattern.replace(ANY_NAME, f"({ANY_NAME})", 1)


def _inside(name: str) -> str:
    """The pattern of text up to the tag that closes an element of this name; elements of its own kind inside are followed to
    ``NESTED_LEVELS``. Tags once passed are never tried another way, so a text costs one pass, whether it fits or not."""
    other = rf"<(?!{name}{NESTED}|\/{name}>)"
    inside = rf"[^<]*(?:{other}[^<]*)*+"
    for _ in range(NESTED_LEVELS):
        inside = rf"[^<]*(?:(?:{other}|<{name}(?={NESTED}){inside}<\/{name}>)[^<]*)*+"
    return inside


def _tag(part: Simple) -> str:
    """The beginning of a selector's opening tag, up to its attributes."""
    return part.pattern.removesuffix("[^>]*>")


def _closed(part: Simple) -> tuple[str, int]:
    """The pattern of the first element that matches and the group of its content, in one pass over the text. Without the
    group where ``_inside`` does not reach the end; such an element, or one without content, gives an empty text."""
    if part.name:
        return rf"{_tag(part)}(?:[^>]*>({_inside(part.name)})(?=<\/{part.name}>)|)", 1
    void = rf"(?:{'|'.join(VOID)}){NESTED}"
    return rf"{_tag(part).replace(ANY_NAME, f'(?!{void})({ANY_NAME})', 1)}[^>]*>({_inside(chr(92) + '1')})(?=<\/\1>)|{_tag(part)}", 2


def contents(html: Column, part: Simple) -> Column:
    """array<string>: the contents of all elements that match, in page order; nested ones too."""
    if part.name is None or part.name in VOID:
        return F.transform(elements(html, part), lambda e: e["body"])
    # ahead of the search, so that it goes on behind the opening tag
    pattern = rf"{_tag(part)}(?:[^>]*>(?=({_inside(part.name)})<\/{part.name}>)|)"
    none = F.array().cast("array<string>")

    def settle(found: Column) -> Column:
        return F.when(F.array_contains(found, ""), F.transform(elements(html, part), lambda e: e["body"])).otherwise(found)
    return F.when(html.contains(part.holds), let(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), settle)).when(html.isNotNull(), none)


def _to_close(text: Column, part: Simple) -> Column:
    """Content of the first element that matches, or NULL, however it ends."""
    cut = F.regexp_extract(text, _named(part)[:-1] + _TO_END, 1 if part.name else 2)
    name = part.name or F.regexp_extract(text, _named(part), 1)
    return let(cut, lambda x: F.when(x != "", element(F.substring(x, 2, 1 << 30), name)))


def with_texts(df: DataFrame, source: str, fields: dict[str, str]) -> DataFrame:
    """``df`` with a column for each field: the text of the first element that its selector finds in the
    canonical markup of ``source``, or NULL. The same as :func:`first_text`, in steps that are columns of their own:
    every step is compiled and computed once, however many of its kind there are. A pattern gives the content at once;
    only of text without such an element, or where it ends elsewhere, more is asked."""
    parts = {n: selector(sel) for n, sel in fields.items()}
    at, d = dict.fromkeys(fields, source), df
    for depth in range(max(map(len, parts.values()))):
        now = {n: p[depth] for n, p in parts.items() if len(p) > depth}
        d = d.withColumns({f"__cut_{n}": F.regexp_extract(at[n], *_closed(p)) for n, p in now.items()})
        d = d.withColumns({f"__body{depth}_{n}": F.when(F.col(f"__cut_{n}") != "", F.col(f"__cut_{n}"))
                           .when(F.col(at[n]).contains(p.holds), _to_close(F.col(at[n]), p)) for n, p in now.items()})
        at |= {n: f"__body{depth}_{n}" for n in now}
    # an element beyond the first of an outer part may hold what the first does not
    bodies = {n: F.col(at[n]) if len(p) == 1 else F.coalesce(F.col(at[n]), F.when(F.col(f"__body0_{n}").isNotNull(), first_body(source, fields[n])))
              for n, p in parts.items()}
    d = d.select(*df.columns, *[b.alias(f"__{n}") for n, b in bodies.items()])
    d = d.withColumns({f"__{n}": F.when(F.col(f"__{n}").contains("<"), F.regexp_replace(f"__{n}", TAG, "")).otherwise(F.col(f"__{n}")) for n in fields})
    d = d.withColumns({f"__{n}": unescape(f"__{n}") for n in fields})
    # most texts have no blanks around them: a look at both ends is cheaper than the trim
    return d.select(*df.columns, *[F.when(F.col(f"__{n}").rlike(_EDGE), strip_ws(f"__{n}")).otherwise(F.col(f"__{n}")).alias(n) for n in fields])


def attribute(tag, name: str) -> Column:
    """Decoded value of an attribute of an opening tag in canonical form, or NULL without one."""
    t = as_col(tag)
    found = _found(t, rf'\s{re.escape(name)}="[^"]*"')
    return unescape(F.substring_index(F.substring_index(found, '"', 2), '"', -1))


def settled(df: DataFrame, *cols: str) -> DataFrame:
    """The same rows, with ``cols`` computed where they are: a filter on them stays above, instead of being
    moved below the projections with all of their expressions written out once more. Nor are the expressions of a
    join's key followed down through the projections, which takes memory that doubles with each of them."""
    rest = [c for c in df.columns if c not in cols]
    kept = df.select(*rest, F.inline_outer(F.array(F.struct(*cols))))
    return kept.select(*df.columns)


def all_elements(html, sel: str) -> Column:
    """array<struct<tag, body>> of all elements that match a selector, in page order."""
    def down(h: Column, parts: list[Simple]) -> Column:
        if len(parts) == 1:
            return elements(h, parts[0])
        # elements inside one another hold the same matches: only the outermost of each part are looked into
        return F.flatten(F.transform(_outermost(h, parts[0]), lambda b: down(b, parts[1:])))
    return down(as_col(html), selector(sel))


def _outermost(html: Column, part: Simple) -> Column:
    """Bodies of the matching elements that lie in no other one, in page order."""
    state = F.struct(F.array().cast("array<string>").alias("bodies"), F.lit(0).alias("skip"))

    def step(acc: Column, e: Column) -> Column:
        inside = F.regexp_count(e["body"], F.lit(part.pattern))
        return F.when(acc["skip"] > 0, F.struct(acc["bodies"].alias("bodies"), (acc["skip"] - 1).alias("skip"))).otherwise(
            F.struct(F.concat(acc["bodies"], F.array(e["body"])).alias("bodies"), inside.alias("skip")))

    return F.aggregate(elements(html, part), state, step, lambda s: s["bodies"])
