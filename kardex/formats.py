"""Options that sources, sinks and text round trips share, so that what a sink
writes a source reads back unchanged."""

from __future__ import annotations

#: One record per ``\n``: files split across tasks, and a carriage return (the
#: multi-value delimiter) is data.  Quotes are doubled, blanks are kept.
CSV_WRITE = {
    "escape": '"', "lineSep": "\n", "encoding": "UTF-8", "quoteAll": "false",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": "", "emptyValue": '""',
}

#: An unquoted empty cell is null, a quoted one is the empty text.
CSV_READ = {
    "escape": '"', "lineSep": "\n", "encoding": "UTF-8", "nullValue": "\u0000", "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
