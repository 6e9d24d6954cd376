"""Regular expressions (Java syntax), word lists and thresholds.

These decide which characters count as a comment, a formula, a sentence end and so on, so they must have
exactly these values for results to agree with existing datasets. ``.`` is written ``[^\\n]`` where only the
newline may be excluded, and braces are escaped because Java requires it.
"""

# White space as Unicode defines it; spelled out so that other engines can use the same class.
SPACE = r"[\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# The same set plus the four separators U+001C to U+001F, which trimming also removes.
TRIM_SPACE = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The characters of ``TRIM_SPACE``, and the space that ``squeeze_space`` has to change: all but a single plain one.
TRIM_CHARACTERS = "".join(
    map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
SPACE_TO_SQUEEZE = SPACE + r"{2,}|" + SPACE.replace(r"\x{20}", "")

# Comments: from an unescaped percent sign to the end of the line.
COMMENT = r"(?<!\\)%[^\n]*"
COMMENT_AND_NEWLINE = r"(?<!\\)%[^\n]*\n?"

# Environments removed as a whole.
DROPPED_ENVIRONMENTS = ("figure", "algorithm", "lstlisting")

# Commands removed from sentences; equation and multline delimiters stay.
MARKUP_COMMAND = (
    r"(?!\\(?:begin|end)\{(?:equation|multline)\})"
    r"(?:\\begin\{[^\n]*?\}|\\end\{[^\n]*?\}|\\label\{[^\n]*?\}|\\item|\\qqq|\\ee"
    r"|\\ref\{[^\n]*?\}|\\eqref\{[^\n]*?\}|\\footnote\{[^\n]*?\}|\\cite\{[^\n]*?\})"
)

# Math delimiters removed before formulas are compared.
MATH_DELIMITER = r"\\(?:begin|end)\{(?:equation|align|math)\}|\\[()\[\]]|\$"

# Preamble lines and layout commands that carry no document text.
PREAMBLE_PARTS = (
    r"^[^.]*?(?=\\title\{.*?\})",
    r"\\documentclass.*?\n",
    r"\\usepackage.*?\n",
    r"\\newcommand.*?\n",
    r"\\def.*?\n",
    r"\\DeclareMathAlphabet.*?\n",
    r"\\SetMathAlphabet.*?\n",
    r"\\DeclareMathOperator.*?\n",
    r"\\let.*?\n",
    r"\\maketitle",
    r"\\noindent",
)
PREAMBLE = "(?s)" + "|".join(PREAMBLE_PARTS)

# Formula kinds, in output order: name, literal that must occur, pattern.
FORMULA_KINDS = (
    ("equation", r"\begin{equation}", r"(?s)\\begin\{equation\}.*?\\end\{equation\}"),
    ("align", r"\begin{align}", r"(?s)\\begin\{align\}.*?\\end\{align\}"),
    ("math", r"\begin{math}", r"(?s)\\begin\{math\}.*?\\end\{math\}"),
    ("display_dollar", "$$", r"(?s)\$\$.+?\$\$"),
    ("inline_dollar", "$", r"(?<!\$)\$[^\$]+\$(?!\$)"),
    ("display_bracket", r"\[", r"(?s)\\\[.*?\\\]"),
    ("inline_paren", r"\(", r"(?s)\\\(.*?\\\)"),
)

# Formula spans for sentence work: escapes are honoured, dollar pairs stay within a line.
_SPAN_ARMS = (
    r"(?<!\$)(\${1,2})(?!\$).*?(?<!\\)(?<!\$)\1(?!\$)",
    r"\\begin\{equation\}[\s\S]*?(?<!\\)\\end\{equation\}",
    r"\\\([\s\S]*?(?<!\\)\\\)",
    r"\\\[[\s\S]*?(?<!\\)\\\]",
)
_MULTLINE_ARM = r"\\begin\{multline\}[\s\S]*?(?<!\\)\\end\{multline\}"
FORMULA_SPAN = r"(?d)(?<!\\)(?:" + "|".join(_SPAN_ARMS + (_MULTLINE_ARM,)) + ")"
FORMULA_SPAN_NO_MULTLINE = r"(?d)(?<!\\)(?:" + "|".join(_SPAN_ARMS) + ")"

# A full stop that ends a sentence, and the empty place right after it.
SENTENCE_END = r"(?U)(?<!No)(?<!\.g)(?<!\.e)(?<!\{)\.(?!g\.)(?!e\.)(?!\d)(?=" + SPACE + ")"
AFTER_SENTENCE_END = r"(?<=(?<!No)(?<!\.g)(?<!\.e)(?<!\{)\.)(?=" + SPACE + ")"

# Titles, authors and included files.
TITLE = r"\\title\{([^\n]*)\}"
AUTHOR_OPEN = r"\\author\{"
AUTHOR_NOISE = r"\$\\qquad\$|\\vspace\{[^\n]*?\}|\\hspace\{[^\n]*?\}"
DOCUMENT_BEGIN = r"\begin{document}"
DOCUMENT_END = r"\end{document}"
INCLUDE = r"\\(input|bibliography)\{([^{}\n]*)\}"
INCLUDE_SUFFIXES = {"input": ("", ".tex"), "bibliography": ("", ".bib", ".bbl")}

# Paper files and addresses.
PAPER_PDF = r"^\d+\.\d+\.pdf"
ABSTRACT_PAGE_BASE = "https://arxiv.org/abs/"
PDF_BASE = "https://arxiv.org/pdf/"
SOURCE_BASE = "https://arxiv.org/e-print/"
TITLE_LABEL_CHARS = 6

# Widths and thresholds.
CONTEXT_CHARS = 70
SHORT_SENTENCE_CHARS = 12
LONG_SENTENCE_CHARS = 800
MIN_JACCARD = 0.65
SIGNATURE_ROWS = 128
SAVE_EVERY_PAPERS = 10
