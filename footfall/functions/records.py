"""``name=value|name=value`` records and ``a_b_c`` keys, kept for old exports.

New tables use real columns; these expressions only decode or rewrite old text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

def record_get(record: Column, field: str) -> Column:
    """Value of the first ``field=value`` entry.

    An entry with an empty value, or with text after a second ``=``, counts as absent.
    """
    entry = rf"(?:^|[|]){re.escape(field)}=([^|=]+)=*(?=[|]|$)"
    return F.nullif(F.regexp_extract(record, entry, 1), F.lit(""))


def record_set(record: Column, field: str, value: Column) -> Column:
    """Replace the value of the first entry called ``field``; other entries keep their place.

    A record without such an entry is returned unchanged.
    """
    fenced = F.concat(F.lit("|"), record, F.lit("|"))
    # Positions in the fenced text; minus one they are positions in the record.
    with_value, bare = F.instr(fenced, f"|{field}="), F.instr(fenced, f"|{field}|")
    start = F.least(F.nullif(with_value, F.lit(0)), F.nullif(bare, F.lit(0)))
    end = F.call_function("locate", F.lit("|"), fenced, start + 1)
    head, tail = F.left(record, start - 1), F.substr(record, end - 1)
    replaced = F.concat(head, F.lit(f"{field}="), value, tail)
    return F.when(start.isNotNull(), replaced).otherwise(record)


def key_part(key: Column, position: int, separator: str = "_") -> Column:
    """Part number ``position`` (from 1) of a joined key; NULL when there are fewer parts."""
    return F.get(F.split(key, separator), position - 1)
