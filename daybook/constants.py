"""Fixed values that must equal the reference app's for the same results.

Everything here is a literal rule of the app: texts of the prompts, default
lengths, thresholds and the prompt line formats.  They are kept together and
in the order the app uses them.
"""

# --- fixed values ---------------------------------------------------------

# task priorities and the click cycle high -> med -> low -> high
PRIORITY_CYCLE = {"high": "med", "med": "low", "low": "high"}
DEFAULT_PRIORITY = "med"

# focus timer defaults, in minutes
DEFAULT_WORK_MINS = 25
DEFAULT_BREAK_MINS = 5

# notification rules
IDLE_THRESHOLD_MINUTES = 45
IDLE_CHECK_MINUTES = 5
EOD_HOUR = 17

# chat request settings
MAX_TOKENS = 1024
DEFAULT_TONE = "professional but direct"

SYSTEM_PROMPT = (
    "You are a focused personal accountability coach built into a productivity app.\n"
    "Your job is to help the user stay on track, prioritize clearly, and reflect honestly.\n"
    "Be direct, warm, and brief — no fluff. Bullet points over paragraphs. No emoji."
)

# kickoff prompt: "<list>" is the numbered pending list, "i. [priority] title"
KICKOFF_HEAD = "It's the start of my day. Here are my pending tasks:\n\n"
KICKOFF_TAIL = (
    "\n\nGive me:\n"
    "1. A suggested order to tackle these (reorder if needed, explain briefly why)\n"
    "2. Any tasks I should defer or break down\n"
    "3. One thing to watch out for today"
)
# text shown instead of a request when nothing is pending
KICKOFF_EMPTY = "No pending tasks. Add some in the Today tab first, then come back for your kickoff."

# day review prompt
REVIEW_HEAD = "Here's my day:\n\nCompleted:\n"
REVIEW_PENDING = "\n\nStill pending:\n"
REVIEW_POMODOROS = "\n\nPomodoros: "
REVIEW_TAIL = (
    "\n\nGive me:\n"
    "1. A quick honest assessment of today\n"
    "2. What to carry forward tomorrow (top 3 only)\n"
    "3. One thing to do differently tomorrow"
)
REVIEW_NONE = "none"

# drift check prompt
DRIFT_HEAD = "I'm supposed to be working on: \""
DRIFT_MID = "\"\n\nI'm about to ask: \""
DRIFT_TAIL = (
    "\"\n\nIs this related to my current task? Reply with one of:\n"
    "- ON TRACK: [one sentence why]\n"
    "- DRIFTING: [one sentence why, and what I should do instead]"
)
DRIFT_MARKER = "DRIFTING"

# note summary prompt
SUMMARY_HEAD = (
    "Summarize the following note in 1-3 concise bullet points. "
    "Extract the key facts, decisions, or action items. Be brief.\n\nNote:\n"
)

# draft prompt
DRAFT_HEAD = "Draft a "
DRAFT_CONTEXT = " message.\n\nContext: "
DRAFT_TONE = "\nTone: "
DRAFT_TAIL = "\n\nGive me 2 short variants. Label them Option A and Option B."

# what the history records instead of the real prompt
KICKOFF_HISTORY_TEXT = "morning kickoff"
REVIEW_HISTORY_TEXT = "end of day review"

# session badges
LABEL_FOCUSED = "focused"
LABEL_DISTRACTED = "distracted"

# timer notices: title and text; the first takes the day's count so far and the break's minutes
LOGGED_TITLE = "Pomodoro logged!"
LOGGED_TEXT = "{} today. Take a {}-min break."
BREAK_OVER_TITLE = "Break over!"
BREAK_OVER_TEXT = "Ready for your next pomodoro?"

# white space removed by the app's trim (all Unicode space separators,
# line terminators, tab, vertical tab, form feed and the byte-order mark)
JS_WHITESPACE_CHARS = (
    "\t\n\u000b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
# the same set as a regular-expression class
JS_WHITESPACE_CLASS = (
    r"[\t\n\u000B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
)

# --- end of fixed values --------------------------------------------------
