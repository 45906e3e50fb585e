"""Prompt wording per task. Each task picks one entry by a seeded hash of the row key."""

VIDEO = [
    "Watched so far: {hist}\nName the videos that come next.",
    "The viewer's recent clips are {hist}. Which clips follow?",
    "Continue this viewing sequence: {hist}",
]
AD = [
    "{hist}\nWhich ads will be opened next?",
    "Given the record below, list upcoming ad clicks.\n{hist}",
]
PRODUCT = [
    "{hist}\nWhich goods will be viewed next?",
    "Given the record below, list the goods of interest.\n{hist}",
]
LABEL_COND = [
    "{hist}\nName videos with the outcome {label}.",
    "Record:\n{hist}\nWhich videos would end in {label}?",
]
LABEL_PRED = [
    "{hist}\nWould the viewer finish {cand}?",
    "Record:\n{hist}\nDecide for {cand}: watched long or not?",
]
ITEM = [
    "Describe the item {sid}.",
    "What is shown in {sid}?",
    "Write a caption for {sid}.",
]
INTERACTIVE = [
    "Profile: {profile}\nRequest: {keyword}\nSuggest items.",
    "About the user: {profile}. They ask for {keyword}; what fits?",
]
REASON = [
    "Profile: {profile}\nHistory: {hist}\nTarget: {target}\nExplain the link.",
]
ITEM_TEXT = [
    "Item {sid} shows: {caption}",
    "{caption} This is item {sid}.",
]
EVENT_NAMES = {
    "longview": "a long view",
    "like": "a like",
    "follow": "a follow",
    "forward": "a share",
    "not_interested": "a dismissal",
}
#: One of these opens each chat; explanation rows have no system turn.
SYSTEM = {
    "video": ["You recommend videos from a viewing record.", "Given what a viewer watched, you name the next videos."],
    "ad": ["You foresee which ads a viewer will open.", "You recommend ads from viewing and click records."],
    "product": ["You foresee which goods a viewer will look at.", "You recommend goods from viewing and shopping records."],
    "label_cond": ["You recommend videos that lead to a given reaction.", "Given past reactions, you name videos for the wanted one."],
    "label_pred": ["You judge whether a viewer will watch a video for long.", "You answer with one character: 是 or 否."],
    "item_understand": ["You describe items by their ids.", "You know what every item shows."],
    "interactive": ["You suggest items that fit a user's request.", "You recommend for a stated wish and a profile."],
}
#: What stands before each part of a history.
LEADS = {
    "video": ["Long views: ", "Watched for long: "],
    "ad": ["Ad clicks: ", "Opened ads: "],
    "goods": ["Goods viewed: ", "Looked at these goods: "],
    "longview": ["Ended in a long view: ", "Long views: "],
    "like": ["Ended in a like: ", "Liked: "],
    "follow": ["Ended in a follow: ", "Followed the author: "],
    "forward": ["Ended in a share: ", "Shared: "],
    "not_interested": ["Ended in a dismissal: ", "Dismissed: "],
}
