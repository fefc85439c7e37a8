"""Markup residue to clean text: HTML/XML, Markdown, wiki and LaTeX, with structure kept.

A document's leftovers are read by one scanner per format family.  Structure survives in a neutral notation: ``# ``
before headings, ``- `` before list items, fenced code blocks, ``| a | b |`` table rows and ``$ … $`` formulas.

Signs that belong to the text stay: comparisons (``n<30``), significance marks, Windows paths, lineages
(``k__…;p__…``), prices and bracketed citation numbers.

Defined results: null gives null and no structures; a text without markup comes back unchanged.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import map_batches

KINDS = ("heading", "list", "code", "formula", "table")

# Element names of HTML, MathML, JATS and MediaWiki that count as tags.
TAGS = (
    "a abbr abstract address article b big blockquote body br caption center cite code col colgroup dd del dfn div dl dt em figcaption "
    "figure font footer h1 h2 h3 h4 h5 h6 head header hr html i img ins kbd li link mark math meta mfrac mi mn mo mover mrow ms "
    "msqrt mstyle msub msubsup msup mtext munder nav nowiki ol p poem pre q ref references s samp script section small source span "
    "strike strong style sub sup syntaxhighlight table tbody td tfoot th thead title tr tt u ul var xref ext-link italic bold sc "
    "sec list list-item disp-formula inline-formula tex-math label fig graphic named-content styled-content monospace underline"
).split()
_NAME = "|".join(sorted(map(re.escape, TAGS), key=len, reverse=True))
_TAG = re.compile(rf"</?(?:(?:jats|mml|xlink):[A-Za-z][\w-]*|(?:{_NAME}))(?:\s[^<>]*)?/?>", re.I)
_COMMENT = re.compile(r"<!--.*?-->|<!\[CDATA\[|\]\]>|<\?xml[^>]*\?>|<!DOCTYPE[^>]*>", re.S)
_ENTITY = re.compile(r"&(?:#\d{2,6}|#[xX][0-9A-Fa-f]{2,6}|[A-Za-z][A-Za-z0-9]{1,10});")
# LaTeX commands known without an argument in braces.
COMMANDS = (
    "noindent item par newline newpage clearpage hline toprule midrule bottomrule centering quad qquad ldots dots it bf em sc rm tt sl "
    "itshape bfseries small large maketitle textless textgreater textasciitilde textbackslash alpha beta gamma delta epsilon lambda mu "
    "sigma omega chi pi rho tau theta times cdot pm leq geq neq approx sim circ sum prod int frac sqrt log ln exp left right infty"
).split()
_CMD = "|".join(sorted(COMMANDS, key=len, reverse=True))
_LATEX = re.compile(rf"(?<![A-Za-z0-9:\\])(?:\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{{|\\(?:{_CMD})(?![A-Za-z]))|\\[%&#$_,;](?![\w\\])|\\[%&#$_](?=[A-Za-z0-9\s)])|\\begin\{{|(?<=[)~\w-])\\(?:cite|ref|footnote)[a-z]*\{{")
_MATH_ENV = r"equation|align|gather|eqnarray|displaymath|math|multline"
_TEX_FORMULA = re.compile(
    rf"\\\[(.+?)\\\]|\\\((.+?)\\\)|\$\$(.+?)\$\$|(?<![\\$\w])\$(?=[^\s$])([^$\n]*?[^\s$\\])\$(?![\d$])|(?<=\w)\$([_^][^$\n]+?)\$(?!\d)|\\begin\{{(?:{_MATH_ENV})\*?\}}(.+?)\\end\{{(?:{_MATH_ENV})\*?\}}",
    re.S,
)
_XML_FORMULA = re.compile(r"<(?:mml:)?math\b|<(?:jats:)?(?:disp|inline)-formula\b|<(?:jats:)?tex-math\b", re.I)
_MATH_BODY = re.compile(r"[\\^_=<>+]|^[A-Za-z]$|\d\s*[-/*]\s*\d")

_WIKI = re.compile(r"'''?[^'\n]+?'''?|\[\[[^\[\]\n]+\]\]|\{\{[^{}\n]+\}\}|^\{\||^={2,6}[^=\n]+={2,6}[ \t]*\r?$|\[https?://\S+ [^\]\n]+\]", re.M)
_WIKI_SIGN = re.compile(r"''|\[\[|\{[{|]|\n==|\[http")
_WIKI_HEAD = re.compile(r"^(={1,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*\r?$", re.M)
_MD_HEAD = re.compile(r"^(#{1,6})[ \t]+(\S[^\n]*?)[ \t]*#*[ \t]*\r?$", re.M)
_SETEXT = re.compile(r"^(\S[^\n]*)\n(?:={3,}|-{3,})[ \t]*\r?$", re.M)
_MD_LIST = re.compile(r"^[ \t]{0,3}(?:[*+-]|\d{1,2}[.)])[ \t]+(?=\S)", re.M)
_LIST_SIGN = re.compile(r"\n[ \t]{0,3}(?:[*+-]|\d{1,2}[.)])[ \t]")
_WIKI_LIST = re.compile(r"^[*#]+[ \t]*(?=[^\s*#])", re.M)
_FENCE = re.compile(r"^(```|~~~)[^\n]*\n(.*?)\n?^\1[ \t]*\r?$", re.M | re.S)
_MD_TABLE = re.compile(r"^\|?[^\n|]+(?:\|[^\n|]*)+\|?[ \t]*\r?\n\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)*\|?[ \t]*\r?$", re.M)
_MD_INLINE = re.compile(
    r"(?<![\w*\\])(\*{1,3})(?=[^\s*])([^*\n]*?[^\s*])\1(?![\w*])|(?<![\w\\])(__?)(?=[^\s_])([^\n]*?[^\s_\\])\3(?!\w)|(?<![`\w])`([^`\n]+)`(?![`\w])"
    r"|!\[([^\]\n]*)\]\([^)\s]+[^)\n]*\)|\[([^\]\n]+)\]\([^)\s]+[^)\n]*\)|(?<=\S)\[\^\w+\]|~~([^~\n]+)~~|^>[ \t](?=\S)",
    re.M,
)
_INLINE_SIGN = re.compile(r"[*`]|[^\w;_]_\w|^_\w|\]\(|\[\^|~~|^> ", re.M)
# no trace of markup without one of these, but for a mark or number that opens the text
_ANY = re.compile(r"[\\&`*$<'\[\]{|_~\n]")
_QUICK = re.compile(r"[\\&`*$]|<[/A-Za-z!?]|''|\[[\[^!]|\]\(|\[http|\{[{|]|[^\w;_]_|~~|\n(?:[+=>#|-]|\d{1,2}[.)] |---)")


def _entity(m: re.Match) -> bool:
    return html.unescape(m.group()) != m.group()


class Scan:
    """What a text's markup is: the formats seen and the kinds of structure it sets."""

    def __init__(self, text: str) -> None:
        self.inline = False
        self.kinds: set[str] = set()
        self.trace = False
        self.wiki = False
        if not _ANY.search(text) and text[0] not in "+=>#|-0123456789" or not _QUICK.search("\n" + text):
            return
        add = self.kinds.add
        angle = "<" in text
        tags = {m.group().strip("</>").split()[0].lower().rstrip("/").rpartition(":")[2] for m in _TAG.finditer(text)} if angle else set()
        comment = _COMMENT.search(text) if "<!" in text or "]]>" in text or "<?" in text else None
        entity = "&" in text and any(_entity(m) for m in _ENTITY.finditer(text))
        latex = "\\" in text and bool(_LATEX.search(text))
        self.trace = bool(tags or comment or entity or latex)
        bare = text
        if fences := ("```" in text or "~~~" in text) and _FENCE.findall(text):
            add("code")
            bare = _FENCE.sub("\n", text)
        if tags & {"pre", "syntaxhighlight", "source"} or re.search(r"<jats:code\b", text):
            add("code")
            bare = re.sub(r"<(pre|syntaxhighlight|source|jats:code)\b.*?</\1>", "\n", bare, flags=re.S | re.I)
        if "\\begin{" in text and re.search(r"\\begin\{(?:lstlisting|verbatim|minted|alltt)\}", text):
            add("code")
            bare = re.sub(r"\\begin\{(lstlisting|verbatim|minted|alltt)\}.*?\\end\{\1\}", "\n", bare, flags=re.S)
        self.wiki = _WIKI_SIGN.search("\n" + bare) is not None and bool(_WIKI.search(bare)) and not fences
        if tags & {"h1", "h2", "h3", "h4", "h5", "h6", "title"} or (latex and re.search(r"\\(?:sub)*(?:section|paragraph|chapter)\*?\{", bare)):
            add("heading")
        if tags & {"ul", "ol", "li", "list", "list-item", "dl"} or (latex and re.search(r"\\item\b|\\begin\{(?:itemize|enumerate|description)\}", bare)):
            add("list")
        if "table" in tags or (latex and re.search(r"\\begin\{(?:tabular|longtable|table)", bare)):
            add("table")
        if (tags and _XML_FORMULA.search(bare)) or (("$" in bare or "\\" in bare) and any(self._is_math(m) for m in _TEX_FORMULA.finditer(bare))):
            add("formula")
        if self.wiki:
            if _WIKI_HEAD.search(bare):
                add("heading")
            if _WIKI_LIST.search(bare):
                add("list")
            if re.search(r"^\{\|", bare, re.M):
                add("table")
        else:
            if ("#" in bare and _MD_HEAD.search(bare)) or (("\n---" in bare or "\n===" in bare) and _SETEXT.search(bare)):
                add("heading")
            if _LIST_SIGN.search("\n" + bare) and _MD_LIST.search(bare):
                add("list")
            if "|" in bare and "--" in bare and _MD_TABLE.search(bare):
                add("table")
        self.inline = _INLINE_SIGN.search(bare) is not None and bool(_MD_INLINE.search(bare))
        self.trace |= bool(self.kinds) or self.wiki or self.inline

    @staticmethod
    def _is_math(m: re.Match) -> bool:
        body = next((g for g in m.groups() if g), "")
        return m.group()[0] == "\\" or bool(_MATH_BODY.search(body))


def _rows(body: str, row: str, cell: str) -> str:
    lines = []
    for r in re.split(row, body):
        cells = [re.sub(r"\s+", " ", c).strip() for c in re.split(cell, r)]
        if any(cells):
            lines.append("| " + " | ".join(c for c in cells) + " |")
    return "\n\n" + "\n".join(lines) + "\n\n"


def _settled(text: str, step: Callable[[str], str]) -> str:
    """``step`` until nothing changes: every step takes a layer of nesting away."""
    while (after := step(text)) != text:
        text = after
    return text


def clean(text: str | None) -> tuple[str | None, list[str] | None]:
    """(clean text, kinds of structure); the kinds are None where the text holds no markup."""
    if not text:
        return text, None
    scan = Scan(text)
    if not scan.trace:
        return text, None
    kept: list[str] = []

    def keep(s: str) -> str:
        kept.append(s)
        return f"\x00{len(kept) - 1}\x00"

    t = text.replace("\x00", "")
    fence = lambda m: keep("\n\n```\n" + html.unescape(_TAG.sub("", m.group(2))).strip("\n") + "\n```\n\n")
    t = _FENCE.sub(fence, t)
    t = re.sub(r"<(pre|syntaxhighlight|source|jats:code)\b[^>]*>(.*?)</\1>", fence, t, flags=re.S | re.I)
    t = re.sub(r"\\begin\{(lstlisting|verbatim|minted|alltt)\}(?:\[[^\]]*\])?(.*?)\\end\{\1\}", fence, t, flags=re.S)

    def formula(m: re.Match) -> str:
        body = next((g for g in m.groups() if g), "")
        return keep("$" + body.strip() + "$") if Scan._is_math(m) else m.group()

    t = _COMMENT.sub("", t)
    t = re.sub(r"<(?:script|style)\b.*?</(?:script|style)>", " ", t, flags=re.S | re.I)
    t = re.sub(r"<((?:mml:)?math)\b[^>]*>(.*?)</\1>", lambda m: keep("$" + html.unescape(re.sub(r"\s+", " ", _TAG.sub("", m.group(2)))).strip() + "$"), t, flags=re.S)
    t = _TEX_FORMULA.sub(formula, t)
    # tables
    t = re.sub(r"<table\b[^>]*>(.*?)</table>", lambda m: keep(_rows(_TAG.sub(lambda x: x.group() if re.match(r"</?t[rdh]", x.group(), re.I) else "", m.group(1)), r"(?i)</?tr[^>]*>", r"(?i)</t[dh]>\s*<t[dh][^>]*>|</?t[dh][^>]*>").replace("|  |", "|").replace("| |", "|")), t, flags=re.S | re.I)
    t = re.sub(r"\\begin\{tabular\}(?:\{[^}]*\})?(.*?)\\end\{tabular\}", lambda m: keep(_rows(re.sub(r"\\hline|\\(?:top|mid|bottom)rule", "", m.group(1)), r"\\\\", r"(?<!\\)&")), t, flags=re.S)
    if scan.wiki:
        t = re.sub(r"^\{\|[^\n]*\n(.*?)^\|\}", lambda m: keep(_rows(re.sub(r"^[|!]", "", m.group(1), flags=re.M), r"\n-[^\n]*\n|\n(?=\S)", r"\|\||!!")), t, flags=re.M | re.S)
        t = _WIKI_HEAD.sub(lambda m: keep("\n\n# " + m.group(2) + "\n\n"), t)
        t = _WIKI_LIST.sub(lambda m: keep("- "), t)
        t = re.sub(r"<ref\b[^>]*/>|<ref\b[^>]*>.*?</ref>", "", t, flags=re.S | re.I)
        t = re.sub(r"\[\[(?:File|Image|Category):[^\[\]]*\]\]", "", t)
        t = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", t)
        t = re.sub(r"\{\{[^{}|]*\|([^{}|]*)\}\}", r"\1", t)
        t = re.sub(r"\{\{[^{}]*\}\}", "", t)
        t = re.sub(r"\[https?://\S+ ([^\]\n]+)\]", r"\1", t)
        t = re.sub(r"'{2,5}([^'\n]+?)'{2,5}", r"\1", t)
    else:
        t = _MD_TABLE.sub(lambda m: keep(m.group().split("\n")[0]), t)
        t = _MD_HEAD.sub(lambda m: keep("\n\n# " + m.group(2).strip() + "\n\n"), t)
        t = _SETEXT.sub(lambda m: keep("\n\n# " + m.group(1).strip() + "\n\n"), t)
        t = _MD_LIST.sub(lambda m: keep("- "), t)
    t = _MD_INLINE.sub(lambda m: next((g for k, g in enumerate(m.groups(), 1) if g and k not in (1, 3)), ""), t)
    if "\\" in t and _LATEX.search(t):
        t = re.sub(r"\\(?:sub)*(?:section|paragraph|chapter)\*?\{([^{}]*)\}(?:\\label\{[^{}]*\})?", lambda m: keep("\n\n# " + m.group(1).strip() + "\n\n"), t)
        t = re.sub(r"\\begin\{[^{}]*\}(?:\[[^\]]*\])?(?:\{[^{}]*\})?|\\end\{[^{}]*\}", "\n", t)
        t = re.sub(r"\\item\b(?:\[[^\]]*\])?[ \t]*", lambda m: keep("- "), t)
        t = re.sub(r"[ ~]?\\(?:cite|ref|label|footnote|pageref|citep|citet)[a-z]*\*?(?:\[[^\]]*\])?\{[^{}]*\}", " ", t)
        t = re.sub(r"\\textless(?:\{\})?", "<", re.sub(r"\\textgreater(?:\{\})?", ">", t))
        t = _settled(t, lambda x: re.sub(r"(?<![A-Za-z0-9:])\\[A-Za-z]+\*?\{([^{}]*)\}", r"\1", x))
        t = re.sub(r"\{\\(?:it|bf|em|sc|rm|tt|sl|itshape|bfseries)\s+([^{}]*)\}", r"\1", t)
        t = re.sub(rf"(?<![A-Za-z0-9:])\\(?:{_CMD})(?![A-Za-z])[ ]?", "", t)
        t = re.sub(r"\\[,;]", " ", re.sub(r"\\([%&#$_])", r"\1", t)).replace("\\\\", "\n")
    t = re.sub(r"<(?:jats:)?(h[1-6]|title)\b[^>]*>(.*?)</(?:jats:)?\1>", lambda m: keep("\n\n# " + _TAG.sub("", m.group(2)).strip() + "\n\n"), t, flags=re.S | re.I)
    t = re.sub(r"<(?:jats:)?(?:li|list-item)\b[^>]*>(?:\s*<(?:jats:)?p>)?", lambda m: keep("\n- "), t, flags=re.I)
    t = re.sub(r"<br\b[^>]*>", "\n", t, flags=re.I)
    t = re.sub(r"</(?:jats:)?(?:p|div|ul|ol|list|sec|section)>", "\n\n", t, flags=re.I)
    t = _TAG.sub("", t)
    t = _settled(t, lambda x: _ENTITY.sub(lambda m: html.unescape(m.group()).replace("\xa0", " "), x))
    while "\x00" in t:
        t = re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m.group(1))], t)
    t = re.sub(r"[ \t]+(?=\n)", "", re.sub(r"\n{3,}", "\n\n", t)).strip()
    return t, [k for k in KINDS if k in scan.kinds]


def clean_column(df: DataFrame, key: str, text: str, field_name: str) -> DataFrame:
    """(field_name, row_key, clean_text, structures) for every row; structures is null where there is no markup.

    Null texts give null; empty ones stay empty.  Other columns of ``df`` are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [clean(v) for v in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.list_(pa.string()))], names=["row_key", "clean_text", "structures"])

    src = df.select(F.col(key).cast("string").alias("row_key"), F.col(text).alias("value"))
    return map_batches(src, run, "row_key string, clean_text string, structures array<string>").withColumn("field_name", F.lit(field_name))


def structure_rows(cleaned: DataFrame) -> DataFrame:
    """One row per marked-up text and kind of structure, 'none' where the markup sets none."""
    kinds = F.when(F.size("structures") == 0, F.array(F.lit("none"))).otherwise(F.col("structures"))
    return cleaned.where(F.col("structures").isNotNull()).select("field_name", "row_key", F.explode(kinds).alias("structure"))
