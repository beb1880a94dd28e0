"""Regular expressions, in the dialect of java.util.regex.

Fixed values throughout: they decide results, so each is stated as it is used.
``WS`` is the exact set of characters that Python counts as whitespace; Java's
``\\s`` is narrower. ``(?d)`` keeps ``.`` and ``$`` from treating ``\\r`` and the
Unicode line separators as line ends. Code points are written ``\\x{..}``, which
both Java and RE2 read.
"""

# Whitespace: members of a character class, and the same as plain characters.
WS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS_NOT_NEWLINE = (
    r"\t\x{b}-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cleaning. The look-ahead only spares Java three of four attempts at most places.
BOILERPLATE = r"(?iu)(?=[cpa])(?:confidential|private|all rights reserved|copyright)"
SIGNATURE = r"(?isu)best regards.*\z"
BLANK_LINES = rf"\n[{WS}]*\n"
# The look-ahead passes over what needs no change: plain characters, and a single blank before one.
SPACE_RUN = rf"(?! ?[!-~])[{WS_NOT_NEWLINE}]+"
SPACED_NEWLINE = r" *\n *"
CONTROL = r"\p{C}+"
SMART_QUOTES = "“”‘’"
PLAIN_QUOTES = "\"\"''"
# A range that holds them all.
MAYBE_SMART_QUOTE = "[‘-”]"

# Quality scores. What is not special, since removing that leaves little to copy.
ASCII_ORDINARY = rf"[a-zA-Z0-9{WS}]+"
REPEATED_CHAR = r"(?d)(.)\1{4,}"

# Special-character rule. The URL class is one set, never an alternation under
# ``+``, because Java recurses once per repetition of an alternation.
URL_TEXT = r"https?://[a-z$-_!]+"
FENCED_CODE = r"```[\s\S]*?```"
INLINE_CODE = r"(?d)`.*?`"

# Formats by name; a column whose name contains the key has that format.
FORMATS = {
    "email": r"(?d)^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
    "phone": r"(?d)^\+?1?\p{Nd}{9,15}$",
    "date": r"(?d)^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}$",
    "url": (
        r"(?d)^https?:\/\/(?:www\.)?[-a-zA-Z0-9@:%._\+~#=]{1,256}"
        r"\.[a-zA-Z0-9()]{1,6}\b(?:[-a-zA-Z0-9()@:%_\+.~#?&\/=]*)$"
    ),
}

# Instruction detection, on the lower-cased text.
INSTRUCTION_PREFIX = r"^(how to|what is|explain|describe|tell me|can you|please)"
QUESTION_AT_END = r"\?[^\n]*\n?\z"
QUESTION_WORD_PREFIX = r"^(if|when|why|where|who|whose|which|whatever|whom)"
COMMAND_WORDS = (
    "explain", "describe", "list", "analyze", "compare",
    "define", "elaborate", "illustrate", "show", "tell",
)

# Tokens. PIECE cuts a text without loss: the pieces joined are the text. The
# repeat bounds keep matching linear on long runs (64 and 63 are the longest
# mailbox and host-label of RFC 5321 / RFC 1035).
WORD_CHAR = r"\p{L}\p{M}\p{N}_"
NOT_WORD = rf"[^{WORD_CHAR}]+"
URL_PIECE = rf"https?://[^{WS}]+"
EMAIL_PIECE = r"[a-zA-Z0-9._%+-]{1,64}@(?:[a-zA-Z0-9-]{1,63}\.){1,8}[a-zA-Z]{2,63}"
# Holds wherever EMAIL_PIECE does.
_EMAIL_START = r"[a-zA-Z0-9._%+-]{1,64}+@[a-zA-Z0-9-]"
AMOUNT = rf"\p{{Nd}}+(?:[.,]\p{{Nd}}+){{0,8}}%?[{WORD_CHAR}]*"
_DATE = rf"\p{{Nd}}{{4}}-\p{{Nd}}{{2}}-\p{{Nd}}{{2}}[{WORD_CHAR}]*"
# What a piece is that starts with a digit and is no address.
NUMBER_PIECE = rf"{_DATE}|{AMOUNT}"
_REST = rf"{_DATE}|[$€£]?{AMOUNT}|[{WORD_CHAR}]+"
# A word that starts with no number, which most pieces are, and the other ways that are tried after it.
_WORD = rf"[\p{{L}}\p{{M}}_][{WORD_CHAR}]*"
# Not blank. The ranges before the whole set spare Java most of it.
_NOT_BLANK = rf"[!-~[[^ \n]&&[^{WS}]]]"
PIECE_NO_EMAIL = rf"{URL_PIECE}|{_WORD}|[{WS}]+|{_REST}|(?s:.)"
# With e-mail addresses, for texts with "@"; in others a word need not be tried twice.
PIECE = rf"{URL_PIECE}|{EMAIL_PIECE}|{_WORD}|[{WS}]+|{_REST}|(?s:.)"
# The pieces that are not blank.
TOKEN = rf"{URL_PIECE}|{EMAIL_PIECE}|{_WORD}|{_REST}|{_NOT_BLANK}"
TOKEN_NO_EMAIL = rf"{URL_PIECE}|{_WORD}|{_REST}|{_NOT_BLANK}"
# What makes a piece an entity by its shape, tried in this order; the first
# pattern is a cheap test that any of them can match at all.
ENTITY_HINT = r"^(?:https?://.|[$€£]?\p{Nd})|.@."
ENTITY_SHAPES = (
    ("URL", r"^https?://."),
    ("EMAIL", r"@"),
    ("DATE", r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}\z"),
    ("MONEY", r"^[$€£]\p{Nd}+(?:[.,]\p{Nd}+){0,8}\z"),
    ("PERCENT", r"^\p{Nd}+(?:[.,]\p{Nd}+){0,8}%\z"),
    ("NUMBER", r"^\p{Nd}+(?:[.,]\p{Nd}+){0,8}\z"),
)


def coarse_piece(firsts: str, most: int, with_email: bool) -> str:
    """PIECE, but runs of words, blanks and single characters of no entity shape are one match.

    ``firsts`` matches whatever the first piece of a phrase is, or is empty. A match that starts with
    it holds ``most`` pieces from there on, and as many from each further one in it. Others hold one
    piece, or a run in which no piece may open a phrase and none is an entity by its shape.
    """
    piece = PIECE if with_email else PIECE_NO_EMAIL
    kept = "|".join(p for p in (firsts, "https?://", _EMAIL_START if with_email else "") if p)
    single = rf"[!-#%-/:-?\[-^`{{-~]|[$€£](?!\p{{Nd}})|[^{WORD_CHAR}{WS}$€£@]"
    plain = rf"(?:(?!{kept})(?:[\p{{L}}\p{{M}}_][{WORD_CHAR}]*+| (?=[!-~])|{single}|[{WS}]++))++"
    if not firsts:
        return f"{plain}|{piece}"
    ahead = rf"(?:(?!{firsts})(?:{piece})){{0,{most - 1}}}+"
    return f"{plain}|(?:(?={firsts})(?:{piece}){ahead})++|{piece}"


BLANK_PIECE = rf"^[{WS}]"
SENTENCE_END = rf"([.!?])[{WS}]+"

# Language identification.
NOT_LETTERS = r"[^\p{L}]+"
CHAR_TRIGRAM = r"(?s)(?=(...))."
