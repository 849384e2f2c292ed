"""String helpers built from Spark built-ins (JVM side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_value(c, domain: list[str]) -> Column:
    """Title-case a categorical value, keeping the domain's own spelling.

    ``initcap`` lower-cases everything after the first letter of a word, which
    turns ``Wind/Hail`` into ``Wind/hail``. A case-insensitive hit in the
    domain returns the domain spelling; anything else falls back to initcap.
    The lookup is one literal-map probe, not a chain of comparisons, so the
    expression stays small when Catalyst folds it into its input.
    """
    c = _col(c)
    lookup = F.create_map(*[F.lit(x) for v in domain for x in (v.lower(), v)])
    return F.coalesce(F.try_element_at(lookup, F.lower(c)), F.initcap(c))


def keep_digits(c) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "")


#: Between the texts of a joined text, and before a letter that stands for one of these two; alone, for NULL.
_NEXT, _MARK = "\x01", "\x02"


def join_texts(cols: list) -> Column:
    """Several texts as one, from which ``split_texts`` takes them again: any characters, empty ones and NULLs.

    Texts without the two characters, all valid UTF-8, are joined as they are. Others are marked one by one; a text
    that is not valid UTF-8 goes as its bytes' hex digits, since a split would replace what is not.
    """
    def safe(c: Column) -> Column:
        marked = F.replace(F.replace(c, F.lit(_MARK), F.lit(_MARK + "m")), F.lit(_NEXT), F.lit(_MARK + "n"))
        return F.when(c.isNull(), F.lit(_MARK)).when(F.is_valid_utf8(c), marked).otherwise(
            F.concat(F.lit(_MARK + "x"), F.hex(c)))
    texts = F.array(*[_col(c) for c in cols])
    plain, bare = F.array_join(texts, _NEXT, _MARK), F.array_join(texts, "")
    odd = F.contains(bare, F.lit(_NEXT)) | F.contains(bare, F.lit(_MARK)) | ~F.is_valid_utf8(plain)
    return F.when(odd, F.array_join(F.transform(texts, safe), _NEXT)).otherwise(plain)


def split_texts(joined) -> Column:
    """The texts of a joined text as an array; NULL if it is."""
    def plain(c: Column) -> Column:
        text = F.replace(F.replace(c, F.lit(_MARK + "n"), F.lit(_NEXT)), F.lit(_MARK + "m"), F.lit(_MARK))
        return F.when(~F.contains(c, F.lit(_MARK)), c).when(F.startswith(c, F.lit(_MARK + "x")), F.unhex(
            F.substring(c, 3, 2 ** 31 - 1)).cast("string")).when(c != F.lit(_MARK), text)
    texts = F.split(_col(joined), _NEXT, -1)
    return F.when(F.contains(_col(joined), F.lit(_MARK)), F.transform(texts, plain)).otherwise(texts)
