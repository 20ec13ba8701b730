"""Schemas of the comma-separated inputs, as (column, type) in file order."""

PAGES = (
    ("id", "int"),
    ("userNickname", "string"),
    ("userJob", "string"),
    ("userRegionCode", "int"),
    ("userHobby", "string"),
)
FOLLOWS = (("colRel", "int"), ("id1", "int"), ("id2", "int"), ("date", "int"), ("desc", "string"))
ACTIVITY = (
    ("logId", "int"),
    ("byWho", "int"),
    ("whatPage", "int"),
    ("actionType", "string"),
    ("time", "int"),
)
TRAINING = (
    ("age", "double"),
    ("income", "double"),
    ("status", "string"),
    ("gender", "string"),
    ("children", "double"),
    ("model", "string"),
)
QUERY = (
    ("k", "int"),
    ("age", "double"),
    ("income", "double"),
    ("status", "string"),
    ("gender", "string"),
    ("children", "double"),
)
