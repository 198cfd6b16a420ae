"""Fixed values of the match data model. They must stay as they are for results to agree."""

# Event categories by event type; any other type is "Other".
EVENT_CATEGORIES = (
    (("Pass", "Shot", "Dribble", "Carry", "Ball Receipt*"), "Ball Action"),
    (("Duel", "Interception", "Clearance", "Block", "Pressure", "Ball Recovery"), "Defensive Action"),
    (("Goal Keeper",), "Goalkeeper Action"),
    (("Starting XI", "Substitution", "Tactical Shift"), "Tactical"),
    (("Foul Committed", "Foul Won", "Offside"), "Foul/Offside"),
)

# LIKE patterns of a position name, first match wins; no match is "Unknown".
POSITION_GROUPS = (
    (("Goalkeeper",), "Goalkeeper"),
    (("%Back%",), "Defender"),
    (("%Midfield%",), "Midfielder"),
    (("%Wing%", "%Forward%", "%Striker%"), "Forward"),
)
# The narrower ladder, which leaves "Left Center Forward" unknown.
LEGACY_POSITION_GROUPS = POSITION_GROUPS[:3] + (
    (("%Wing%",), "Forward"),
    (("Striker", "Center Forward", "Second Striker"), "Forward"),
)

# Event and card names used by the measures.
DEFENSIVE_ACTIONS = ("Pressure", "Duel", "Interception", "Block", "Foul Committed")
WITH_THE_BALL = ("Ball Receipt*", "Carry")
TACKLE_WON = ("Success In Play", "Won", "Success Out")
SENT_OFF = ("Red Card", "Second Yellow")
BOOKED = ("Yellow Card", "Second Yellow")

# Limits beyond which a measurement is noise.
MAX_DURATION = 10000
MAX_POSSESSION_DURATION = 999
MAX_CLOCK_SECONDS = 18000
BIRTH_YEARS = (1960, 2010)
PRESSING_LINE = 40

# Names of zones 1..19 in use before the zone table was derived from the grid.
LEGACY_ZONES = (
    "Zone 1 (Defensive Left)",
    "Zone 2 (Defensive Center-Left)",
    "Zone 3 (Defensive Center-Right)",
    "Zone 4 (Defensive Right)",
    "Zone 5 (Midfield Left)",
    "Zone 6 (Midfield Center-Left)",
    "Zone 7 (Midfield Center-Right)",
    "Zone 8 (Midfield Right)",
    "Zone 9 (Attacking Left Wing)",
    "Zone 10 (Attacking Half-Space Left)",
    "Zone 11 (Attacking Center)",
    "Zone 12 (Attacking Half-Space Right)",
    "Zone 13 (Attacking Right Wing)",
    "Zone 14 (The Hole / CAM Zone)",
    "Zone 15 (Deep Zone Left)",
    "Zone 16 (Deep Zone Center)",
    "Zone 17 (Deep Zone Right)",
    "Zone 18 (Corner Area)",
    "Penalty Box",
)
# Zones flagged as box.
BOX_ZONES = (16, 19)
