"""The word lists and patterns of the block rules, and a portable form of patterns."""

from __future__ import annotations

# Fixed values that results depend on. Categories, in the order in which reports list them.
CATEGORIES = (
    "Definitions", "Formulas", "Examples / Figures", "Warnings / Caveats",
    "Historical / Empirical References", "Transitional / Structural",
)
DEFINITIONS, FORMULAS, EXAMPLES, WARNINGS, HISTORY, TRANSITION = CATEGORIES

DEFINITION_WORDS = (
    "is known as", "is defined as", "denoted", "let ", "we define", "refers to", "concept", "notion", "consists of", "main types",
    "known as", "represents", "means ", "signifies", "by definition", "differs from", "is called", "can be defined", "is a type of",
    "is the", "are the", "is an", "are an", "also called", "in general", "broadly speaking", "refers to the", "defined as the",
    "can be categorized", "can be classified", "is characterized by",
)
FORMULA_SIGNS = (
    r"\\tag\{", r"\$\$", r"\\begin\{array\}", r"\\operatorname\*", r"\\sum_", r"\\min_", r"\\max_", r"\\int_", r"\\frac\{", r"\\left",
    r"\\right", r"\\begin\{equation\}", r"\\begin\{align\}", r"\\\[", r"\\\]", r"\$[^$]+\$", r"\\begin\{gather\}", r"\\begin\{multline\}",
    r"\\begin\{split\}", r"\\sqrt\{", r"\\alpha", r"\\beta", r"\\gamma", r"\\delta", r"\\sigma", r"\\mu", r"\\mathbb\{", r"\\mathcal\{",
    r"\\mathrm\{", r"\\mathbf\{",
)
EXAMPLE_WORDS = (
    "Figure", "Table", "Algorithm", "Example", "Listing", "parameters", "numerical", "simulation", "pseudocode", "procedure", "steps",
    "python", "code", "import ", "def ", "print(", "output", "result", "returns", "yield", "plot", "chart", "graph", "visualize",
    "interactive", "candlestick", "time series",
)
WARNING_WORDS = (
    "however", "caution", "limitation", "fragile", "assumes", "contradiction", "not confirmed", "differs from", "unlike", "too large",
    "too many", "too small", "only affects", "violation", "penalty", "risk", "danger", "problematic", "underestimate", "overestimate",
    "sensitive", "unstable", "drawback", "shortcoming", "important to note", "must be careful", "beware", "warning", "note that",
    "care must", "should not", "cannot be", "may not", "might not", "does not guarantee", "it is worth noting", "keep in mind",
    "be aware", "caveat", "pitfall",
)
HISTORY_WORDS = (
    "et al.", "study", "empirical", "paper", "work", "framework", "research", "according to", "proposed by", "introduced by",
    "developed by", "in their seminal", "classic paper", "well-known", "widely used", "first described", "originally published",
    "prior work", "previous studies", "literature", "citation", "reference", "survey",
)
TRANSITION_PHRASES = (
    "the next section", "in this chapter", "in the following", "we will look", "let us look", "the following section", "in a nutshell",
    "to summarize", "in summary", "to conclude", "first, ", "second, ", "third, ", "finally, ", "lastly, ", "the next chapter",
    "as mentioned earlier", "as we have seen", "we start by", "we then switch", "we now turn", "we next", "before we", "after we",
    "in the previous", "in the next",
)
CODE_SIGNS = (
    r"^```\w*\s*$", r"^(import |from \S+ import |def |class |print\(|>>> |\.\.\. )", r"^[%\w]+\s*=\s*", r"^\w+\.\w+\(", r"^\w+\(", r"^%\w+",
    r"^\d{4}-\d{2}-\d{2}\s+\d", r"^\d+\.\d+\s+\d+\.\d+", r"^\d+\.\d+$", r"^\d+$", r"^Epoch\s+\d+", r"^['\"]\w+['\"]:\s*['\"\d\[{]",
    r"^\{['\"]\w+['\"]:", r"^[\w\-]+,\s*[\w\-]+,",
)
LATE_DEFINITIONS = "is a|are a|refers to|used to|involves|consists of|contains|provides|describes|represents|denotes|signifies"
LATE_EXAMPLES = "such as|for example|namely|specifically|in particular|consider the|suppose|assume that"
LATE_EXAMPLE_ABBREVIATIONS = r"e\.g\.|i\.e\."
LATE_WARNINGS = "should|must|need to|important|note|beware|careful|avoid|ensure|verify|check that"
LATE_HISTORY = "data|dataset|sample|observation|empirical|measurement|performance|result|finding"
PLACEHOLDERS = r"(^|W)(todo|fixme|placeholder|lorem ipsum)($|W)|\[(insert|todo|placeholder)[^\]]*\]|as an ai language model|i cannot access"

SHORT_DEFINITIONS = "is defined as|is known as|also called|refers to"
FIGURES = ("Figure", "Table", "Algorithm", "Listing", "Example")
FIGURE_NUMBER = r"\s+[\d\-]+"
FENCE, LABEL, HEADING, NUMBERS = r"^(```|\{|\[)\s*$", r"^[A-Z][A-Za-z\s\-/]+:\s", r"^(#{1,6}\s+|---+\s*$)", r"\d+\.\d+|\d+%|\$\d+"

STOP_WORDS = (
    "the", "and", "for", "that", "with", "this", "from", "are", "was", "were", "has", "have", "had", "but", "not", "into", "its", "their",
    "they", "them", "his", "her", "she", "you", "your", "our", "can", "will", "would", "could", "should", "about", "than", "then", "when",
    "where", "what", "which", "who", "how", "why", "also", "there", "because", "chapter", "evidence", "source", "block",
)
# End of fixed values.

#: Letters, digits and the underscore of all scripts, as Java and RE2 both write them.
WORD = r"\p{L}\p{N}_"


def portable(pattern: str) -> str:
    """The pattern with each backslash-w spelled out, so that Java and RE2 take it alike."""
    out, inside, k = [], False, 0
    while k < len(pattern):
        two = pattern[k : k + 2]
        if two == r"\w":
            out.append(WORD if inside else f"[{WORD}]")
            k += 2
        elif two.startswith("\\"):
            out.append(two)
            k += 2
        else:
            inside = (inside or two[0] == "[") and two[0] != "]"
            out.append(two[0])
            k += 1
    return "".join(out)


def bounded(alternatives: str) -> str:
    """A search for any alternative that stands as words of its own."""
    return rf"(^|[^{WORD}])({alternatives})($|[^{WORD}])"


def keywords(words: tuple[str, ...]) -> str:
    """A search in lower-case text: plain phrases stand as words of their own, anything else may stand anywhere."""
    plain = [w.strip().lower() for w in words if w.strip().lower().replace(" ", "").isalnum() and w.isascii()]
    rest = [w.lower() for w in words if w.strip().lower() not in plain]
    escaped = ["".join(c if c.isalnum() or c in " -" else "\\" + c for c in w) for w in rest]
    return "|".join([bounded("|".join(plain)), *escaped])


def first_words(words: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """What a text must have for a search of ``keywords(words)`` to find anything: one of the first list as a word, or one of the second as a part."""
    plain = [w.strip().lower() for w in words if w.strip().lower().replace(" ", "").isalnum() and w.isascii()]
    return sorted({w.split(" ")[0] for w in plain}), [w.lower() for w in words if w.strip().lower() not in plain]


def block_rules(text: str, low: str, stripped: str, count: str, matches) -> list[tuple[str, str]]:
    """The ordered (condition, category) rules as SQL; ``matches(value, pattern)`` writes a search, and with a third argument (``first_words``) one that may look for that first."""
    signs = lambda value, patterns, *needed: matches(value, "|".join(f"({portable(p)})" for p in patterns), *needed)
    # one mark of the beginning before all of them: the search then ends where the text begins
    begins = lambda value, patterns: matches(value, f"^({'|'.join(f'({portable(p.removeprefix(chr(94)))})' for p in patterns)})")
    holds = lambda value, pattern, *parts: matches(value, pattern, ([], list(parts)))
    late = lambda words: matches(low, bounded(words), first_words(tuple(words.split("|"))))
    listed = lambda words: matches(low, keywords(words), first_words(words))
    return [
        (signs(text, FORMULA_SIGNS, ([], ["\\", "$"])), FORMULAS),
        (begins(stripped, CODE_SIGNS), EXAMPLES),
        (matches(stripped, FENCE), EXAMPLES),
        (f"{count} >= 5 AND {matches(stripped, LABEL)}", DEFINITIONS),
        (f"{count} >= 8 AND {listed(DEFINITION_WORDS)}", DEFINITIONS),
        (f"{count} >= 5 AND {late(SHORT_DEFINITIONS)}", DEFINITIONS),
        (f"{count} >= 5 AND {listed(WARNING_WORDS)}", WARNINGS),
        (listed(HISTORY_WORDS), HISTORY),
        (holds(text, rf"(^|[^{WORD}])({'|'.join(FIGURES)}){FIGURE_NUMBER}", *FIGURES), EXAMPLES),
        (f"{count} >= 8 AND ({listed(EXAMPLE_WORDS)} OR {matches(text, NUMBERS)})", EXAMPLES),
        (f"{count} <= 3", TRANSITION),
        (matches(stripped, HEADING), TRANSITION),
        (holds(low, "|".join(TRANSITION_PHRASES), *TRANSITION_PHRASES), TRANSITION),
        (f"{count} >= 12 AND {late(LATE_DEFINITIONS)}", DEFINITIONS),
        (f"{count} >= 12 AND ({late(LATE_EXAMPLES)} OR {holds(low, rf'(^|[^{WORD}])({LATE_EXAMPLE_ABBREVIATIONS})[{WORD}]', 'e.g.', 'i.e.')})", EXAMPLES),
        (f"{count} >= 12 AND {late(LATE_WARNINGS)}", WARNINGS),
        (f"{count} >= 12 AND {late(LATE_HISTORY)}", HISTORY),
    ]


def quoted(value: str) -> str:
    """A SQL string literal for DuckDB; Spark's parser needs ``raw`` ones instead."""
    return "'" + value.replace("'", "''") + "'"
