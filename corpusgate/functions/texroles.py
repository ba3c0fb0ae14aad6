"""What each TeX command and environment does to its arguments."""

# --- fixed values: environments ---
MATH_ENVIRONMENTS = (
    "align", "align*", "aligned", "array", "cases", "displaymath", "equation", "equation*", "gather", "gather*", "gathered",
    "math", "matrix", "multline", "multline*", "pmatrix", "smallmatrix", "split", "vmatrix",
)
FOREIGN_ENVIRONMENTS = ("otherlanguage", "otherlanguage*")
VERBATIM_ENVIRONMENTS = ("verbatim", "verbatim*", "lstlisting", "minted", "filecontents", "filecontents*")
CODE_ENVIRONMENTS = ("tikzpicture", "picture")
# --- fixed values: environments whose first group is an identity ---
ENVIRONMENTS_WITH_ARGUMENT = ("tabular", "array", "adjustbox", "minipage")
# --- fixed values: commands whose argument is prose even inside mathematics ---
MATH_TEXT_COMMANDS = (
    "text", "textrm", "textit", "textbf", "textnormal", "mbox", "hbox", "intertext", "footnote", "footnotetext",
)
# --- fixed values: commands that define other commands, with their number of groups ---
DEFINITION_COMMANDS = {
    "newcommand": 2, "renewcommand": 2, "providecommand": 2, "DeclareRobustCommand": 2, "newenvironment": 3,
    "renewenvironment": 3, "def": 1, "gdef": 1, "edef": 1, "xdef": 1, "DeclareMathOperator": 2, "DeclareMathOperator*": 2,
}
# --- fixed values: commands with an identity in every group ---
IDENTITY_ONE = (
    "label", "ref", "pageref", "eqref", "autoref", "Cref", "cref", "cite", "citep", "citet", "nocite", "url", "path",
    "bibitem", "input", "include", "bibliography", "bibliographystyle", "includegraphics", "index", "tag", "hspace",
    "hspace*", "vspace", "vspace*", "geometry", "thispagestyle", "pagestyle", "pagenumbering", "enlargethispage", "newlength",
)
IDENTITY_TWO = ("setlength", "addtolength", "setcounter", "addtocounter", "rule")
# --- fixed values: commands around foreign text, read even inside mathematics ---
FOREIGN_COMMANDS = ("foreign", "foreignlanguage")
# --- fixed values: commands whose groups differ in role ---
MIXED_ROLES = {
    "foreign": ("protected_foreign",),
    "foreignlanguage": ("protected_foreign", "protected_foreign"),
    "diagbox": ("protected_math", "protected_math"),
    "addcontentsline": ("protected_identity_arg", "protected_identity_arg", "visible_prose"),
    "href": ("protected_identity_arg", "visible_prose"), "texorpdfstring": ("visible_metadata", "visible_metadata"),
    "newtheorem": ("protected_identity_arg", "visible_metadata"), "newtheorem*": ("protected_identity_arg", "visible_metadata"),
    "textcolor": ("protected_identity_arg", "inherit"), "colorbox": ("protected_identity_arg", "inherit"),
}
# --- fixed values: commands whose one group keeps the role around it ---
VISIBLE_ONE = (
    "author", "caption", "chapter", "emph", "footnote", "footnotetext", "hbox", "mbox", "paragraph", "paragraph*", "part",
    "part*", "section", "section*", "subparagraph", "subparagraph*", "subsection", "subsection*", "subsubsection",
    "subsubsection*", "text", "textbf", "textit", "textnormal", "textrm", "textsf", "textsc", "textsuperscript", "texttt",
    "title", "underline", "uline",
)
# --- fixed values: commands whose bracket is prose ---
VISIBLE_OPTIONAL = (
    "item", "chapter", "part", "part*", "section", "section*", "subsection", "subsection*", "subsubsection", "subsubsection*",
    "paragraph", "paragraph*", "subparagraph", "subparagraph*", "caption",
)
# --- fixed values: commands without arguments ---
SWITCHES = (
    "bfseries", "centering", "em", "footnotesize", "Huge", "huge", "itshape", "large", "Large", "LARGE", "normalsize",
    "normalfont", "raggedleft", "raggedright", "rmfamily", "scriptsize", "sffamily", "small", "slshape", "tiny", "ttfamily",
    "upshape",
)
# --- fixed values: commands that may only be followed by an empty group ---
EMPTY_GROUP = ("S", "glqq", "grqq")


def argument_policy() -> list[tuple[str, int, str]]:
    """``(command, arg_no, role)`` rows; ``arg_no`` 0 stands for a bracket."""
    rows = [(c, 1, "protected_identity_arg") for c in IDENTITY_ONE]
    rows += [(c, k, "protected_identity_arg") for c in IDENTITY_TWO for k in (1, 2)]
    rows += [(c, k, role) for c, roles in MIXED_ROLES.items() for k, role in enumerate(roles, 1)]
    rows += [(c, 1, "math_text" if c in MATH_TEXT_COMMANDS else "inherit") for c in VISIBLE_ONE]
    rows += [("intertext", 1, "math_text")]
    rows += [(c, k, "protected_definition") for c, n in DEFINITION_COMMANDS.items() for k in range(0, n + 1)]
    rows += [(c, 0, "inherit") for c in VISIBLE_OPTIONAL]
    known = {c for c, _, _ in rows}
    brackets = {c for c, k, _ in rows if k == 0}
    rows += [(c, 0, "protected_identity_arg") for c in sorted(known | {"footnotemark"}) if c not in brackets]
    rows += [(f"env:{e}", 1, "protected_identity_arg") for e in ENVIRONMENTS_WITH_ARGUMENT]
    rows += [(f"env:{e}", 1, "protected_foreign") for e in FOREIGN_ENVIRONMENTS]
    rows += [(f"env:{e}", 0, "protected_identity_arg") for e in ("enumerate", "description", "itemize")]
    return rows


#: Commands that a policy need not list: they take no argument, or only a bracket.
WITHOUT_ARGUMENT = (*SWITCHES, "item", "footnotemark")
