"""Line formats understood by the parser.

FIXED VALUES. The patterns below must stay equal to the formats of the original log
tooling, otherwise lines are split differently and every report changes. They are
written here in their natural order, as plain regex text.

``COMBINED`` is searched (first match anywhere in the line, like ``Matcher.find``).
Groups: 1 ip (optional dotted quad), 2 client, 3 user, 4 bracketed date,
5 request (quotes stripped), 6 three-digit status, 7 byte count (may be ``-``),
8 referer, 9 agent.

``SERDE`` is the Hive RegexSerDe input format. The SerDe matches the whole line, so it
is anchored here, in the filter and in every extraction; quotes stay part of the values
and the trailing referer/agent pair is optional. ``\\z`` (end of input) is used rather
than ``$``, which in Java also matches before a final line terminator.
"""

# --- fixed values: combined access-log format (searched, not anchored) ---
COMBINED = (
    r'(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) "(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"'
)

# --- fixed values: regex SerDe format (whole line) ---
SERDE = (
    r'^([^ ]*) ([^ ]*) ([^ ]*) (-|\[[^\]]*\]) ([^ "]*|"[^"]*") (-|[0-9]*) (-|[0-9]*)'
    r'(?: ([^ "]*|"[^"]*") ([^ "]*|"[^"]*"))?\z'
)
# Same format with the referer/agent pair required. A line matching SERDE but not
# SERDE9 has no groups 8/9, which the SerDe reports as NULL; regexp_extract alone
# cannot tell an absent group from an empty one.
SERDE9 = (
    r'^([^ ]*) ([^ ]*) ([^ ]*) (-|\[[^\]]*\]) ([^ "]*|"[^"]*") (-|[0-9]*) (-|[0-9]*)'
    r' ([^ "]*|"[^"]*") ([^ "]*|"[^"]*")\z'
)
# Same format again, the optional pair captured as a whole (group 8, referer 9,
# agent 10): one match tells whether the pair is present (group 8 non-empty).
SERDE_TAIL = (
    r'^([^ ]*) ([^ ]*) ([^ ]*) (-|\[[^\]]*\]) ([^ "]*|"[^"]*") (-|[0-9]*) (-|[0-9]*)'
    r'( ([^ "]*|"[^"]*") ([^ "]*|"[^"]*"))?\z'
)

# Output column names; position = regex group number - 1.
FIELDS = ("ip", "client", "user", "date_time", "request", "status", "bytes", "referer", "agent")

DIALECTS = ("combined", "regexserde")
BYTE_POLICIES = ("drop", "zero", "null", "fail")
