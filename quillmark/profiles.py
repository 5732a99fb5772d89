"""Language profiles: the values a text rule needs to know about a script.

Every rule in :mod:`quillmark.functions` takes a profile, so that one expression serves any
language. ``ARABIC`` is the default; ``LATIN`` covers English, German, French and Spanish.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from quillmark.charclasses import BLANK, WORD_END, WORD_START


@dataclass(frozen=True)
class LanguageProfile:
    """Fixed values of one script. Fields ending in ``_class`` are bodies of regex classes."""

    name: str
    letter_class: str  # native script: script tokens, and letters that are not foreign
    keep_class: str  # characters that survive `keep_script`, next to white space
    fold_from: str  # letters replaced one by one ...
    fold_to: str  # ... by these
    final_from: str  # letter replaced at the end of a word ...
    final_to: str  # ... by this one
    mark_class: str  # diacritics
    stopwords: tuple[str, ...]
    prefixes: tuple[str, ...]
    suffixes: tuple[str, ...]
    segment_marks: str  # marks that separate the segments counted as sentences
    sentence_marks: str  # marks that end a sentence when voice is judged
    passive_pattern: str  # what a sentence in passive voice contains
    min_stem: int = 3  # letters an affix must leave

    def folded(self) -> "LanguageProfile":
        """Same profile with its stopwords passed through the letter folding first.

        Stopwords are matched after folding, so words written with a folded letter never match
        as listed. This variant makes them match.
        """
        table = str.maketrans(self.fold_from, self.fold_to)
        words = (w.translate(table) for w in self.stopwords)
        final = self.final_from
        words = (w[: -len(final)] + self.final_to if w.endswith(final) else w for w in words)
        return replace(self, name=f"{self.name}_folded", stopwords=tuple(dict.fromkeys(words)))


# ---- Fixed values: Arabic -------------------------------------------------------------------

ARABIC = LanguageProfile(
    name="arabic",
    letter_class=r"\u0600-\u06ff\u0750-\u077f\u08a0-\u08ff\ufb50-\ufdff\ufe70-\ufeff",
    keep_class=r"\u0600-\u06ff",
    fold_from="أإآى",
    fold_to="اااي",
    final_from="ة",
    final_to="ه",
    mark_class=r"\u064b-\u065f\u0670",
    stopwords=tuple(
        """
        في من على إلى عن هذا هذه ذلك تلك هؤلاء
        أولئك الذي التي الذين اللاتي اللواتي ما ماذا
        متى أين كيف لماذا كم أو أم لكن بل حتى
        إذا إذ إن أن كان كانت يكون تكون هو هي
        هم هن نحن أنت أنتم أنا قد قال قالت قالوا
        كل بعض غير بين عند منذ حول قبل بعد فوق
        تحت أمام خلف يمين يسار الى ولا وما لا
        لم لن ولم ولن فلا فقط أيضا كذلك ثم
        """.split()
    ),
    prefixes=("ال", "بال", "كال", "فال", "وال", "لل", "و", "ف", "ب", "ل", "ك", "س", "ست", "سي", "ا"),
    suffixes=("ون", "ين", "ات", "ها", "هم", "هن", "نا", "كم", "كن", "ك", "ه", "ة", "ت", "ا", "ي"),
    segment_marks='.!?؟؛:،-–()"[]',
    sentence_marks=".!?؟؛",
    passive_pattern=(
        WORD_START + r"\u0623\u064f[\u064b-\u065f]?[\u0627-\u064a]|" + WORD_START + r"\u0627\u0633\u062a\u0651"
    ),
)

# ---- Fixed values: Latin --------------------------------------------------------------------

LATIN = LanguageProfile(
    name="latin",
    letter_class=r"\p{IsLatin}",
    keep_class=r"\p{IsLatin}\u0300-\u036f",
    fold_from="áàâäãéèêëíìîïóòôöõúùûüçñ",
    fold_to="aaaaaeeeeiiiiooooouuuucn",
    final_from="ß",
    final_to="s",
    mark_class=r"\u0300-\u036f",
    stopwords=tuple(
        """
        the and of to in is are was were for on with by that this it as at from be an or not
        der die das und ist nicht ein eine mit von den dem zu im auf
        le la les et de des du un une est dans que qui pour par
        el los las y en por con para una se del
        """.split()
    ),
    prefixes=("under", "over", "anti", "inter", "re", "un", "in", "ge", "de"),
    suffixes=("ations", "ation", "ments", "ment", "tions", "tion", "ings", "ing", "ers", "er", "ed", "es", "ly", "en", "s"),
    segment_marks='.!?:;,-–()"[]',
    sentence_marks=".!?;",
    passive_pattern=(
        WORD_START + rf"(?:was|were|is|are|been|being){BLANK}+\p{{L}}+ed" + WORD_END
    ),
)

PROFILES = {p.name: p for p in (ARABIC, LATIN)}
