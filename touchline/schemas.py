"""Column layouts of the inputs, as Spark DDL. Readers never infer a schema."""

DOODLE = (
    "word string, countrycode string, recognized boolean, key_id string, "
    "timestamp string, drawing array<array<array<double>>>"
)
# As files have it: `recognized` may be written as a boolean or as 1 and 0.
DOODLE_FILE = DOODLE.replace("recognized boolean", "recognized variant")
SHAPE = "key_id string, word string"
SHAPE_WITH_COUNTRY = "key_id string, word string, countrycode string"
STROKE_STATS = "key_id string, word string, recognized string, Total_Strokes string"
STROKE_STATS_WITH_COUNTRY = STROKE_STATS + ", countrycode string"
EDGE = "src string, dst string"
RANK = "node string, rank double"
PLAYER = (
    "Id bigint, name string, birthDate date, birthArea string, foot string, "
    "role string, height int, weight int"
)
TEAM = "Id bigint, name string"

ENTRY = (
    "struct<playerId:bigint,ownGoals:string,goals:string,"
    "yellowCards:string,redCards:string>"
)
SUBSTITUTION = "struct<playerIn:bigint,playerOut:bigint,minute:int>"
TEAM_DATA = (
    f"struct<hasFormation:int,formation:struct<lineup:array<{ENTRY}>,"
    f"bench:array<{ENTRY}>,substitutions:array<{SUBSTITUTION}>>>"
)
TEAMS_DATA = f"map<string,{TEAM_DATA}>"
TAGS = "array<struct<id:bigint>>"

MATCH = (
    "match_id bigint, seq int, dateutc string, label string, winner bigint, gameweek int, "
    f"duration string, venue string, teamsData {TEAMS_DATA}"
)
EVENT = (
    "match_id bigint, seq bigint, eventId int, subEventId int, playerId bigint, "
    f"eventSec double, tags {TAGS}"
)

# One line of the mixed stream. `source` and `position` say where in which stream a line stood;
# a formation that is absent arrives as the text "null" and is read as missing.
STREAM_LINE = (
    "source string, position bigint, matchId bigint, "
    "dateutc string, label string, winner bigint, gameweek int, duration string, venue string, "
    f"teamsData {TEAMS_DATA}, "
    "eventId int, subEventId string, playerId bigint, eventSec string, " + f"tags {TAGS}, `end` boolean"
)

WIN_REQUEST = "request_id bigint, date date, team1 map<string,string>, team2 map<string,string>"
PROFILE_REQUEST = "request_id bigint, name string"
MATCH_REQUEST = "request_id bigint, date date, label string"

# One line of a file of requests of all kinds. The kind is 1, 2 or 3; without one, match information is meant.
MIXED_REQUEST = (
    "request_id bigint, req_type string, date string, team1 map<string,string>, team2 map<string,string>, "
    "name string, label string"
)
