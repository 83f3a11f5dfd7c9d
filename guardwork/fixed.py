"""Fixed values.

The texts below are stored in job steps, shown in reports or told to users, so
they must be spelled exactly like this for results to be right.  Nothing else in
the package repeats them.
"""

# Names of the two guard steps.
GUARD_STEP_1_NAME = "AGRun Status Check Step 1"
GUARD_STEP_2_NAME = "AGRun Status Check Step 2"

# The text in front of the config name, and the guard command.
CONFIG_MARKER = "@AGRunConfigName = '"
GUARD_COMMAND_HEAD = "EXECUTE [SQLJob].[AGRunStatusCheck] @JobStepID = "
GUARD_COMMAND_TAIL = "'\t"

# Status texts of the guard audit.
STATUS_NOT_SET_UP = "No AGRun Steps Setup"
STATUS_BYPASSED = "Error-Does not start on step 1. AGRun steps bypassed"
STATUS_CONFIG_MISSING = "Error-AGRun Config Missing"
STATUS_NOT_SAME_CONFIG = "Error-Steps for AGRun are not using same config"
STATUS_CONFIGURED = "AGRun Steps Configured"

# Role, action codes, principal types, event type, object type.
ROLE_PRIMARY = "PRIMARY"
QUIT_WITH_SUCCESS = 1
QUIT_WITH_FAILURE = 2
GO_TO_STEP = 4
USER_TYPES = ("S", "U")
GRANT_EVENT = "GRANT_DATABASE"
INTERNAL_TABLE = "IT"

# Message for a refused grant.
GRANT_REFUSED = (
    "You can not assign permissions to a user. "
    "If you think it is in error please contact a DBA"
)

# Pattern and names of the expected internal tables.
FULLTEXT_PATTERN = "FullText%"
FULLTEXT_TABLES = (
    "fulltext_thesaurus_metadata_table",
    "fulltext_thesaurus_phrase_table",
    "fulltext_thesaurus_state_table",
)

# Our own status: a guard is there by name, but its command holds no config name.
STATUS_UNREADABLE = "Error-Guard command holds no readable config name"

# Our own status: several configs have the name, so none of them is meant.
STATUS_CONFIG_AMBIGUOUS = "Error-Several configs of this name"
