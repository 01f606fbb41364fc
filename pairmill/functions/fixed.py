"""Word lists, patterns and texts that decide the results."""

# --- Fixed values -------------------------------------------------------------
# Character classes. Java's \w and \s are ASCII only by default; the results
# are defined on the Unicode classes, spelled out here (without brackets).
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

ZERO_WIDTH = r"[\x{200B}-\x{200F}\x{2028}-\x{202F}\x{FEFF}]"
MARKUP = r"<(?!/?(?:ph_[a-z0-9_]*|url|email|user|num|unk|pad|sos|eos)>)[^<>]{1,40}>"
SLOT = rf"\{{\{{[{SPACE}]*([^{{}}]+?)[{SPACE}]*\}}\}}"
URL = rf"(?iu)https?://[^{SPACE}]+|www\.[^{SPACE}]+"
EMAIL = rf"{EDGE}[{WORD}.+\-]++@[{WORD}\-]++\.[{WORD}.\-]+{EDGE}"
USER = rf"(?<![{WORD}])@[{WORD}]{{2,}}"
HASHTAG = rf"(?<![{WORD}])#([{WORD}]+)"
EMOJI = (r"[\x{1F300}-\x{1F5FF}\x{1F600}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}"
         r"\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}\x{2600}-\x{27BF}\x{FE00}-\x{FE0F}"
         r"\x{2190}-\x{21FF}\x{2B00}-\x{2BFF}\x{1F1E6}-\x{1F1FF}]+")
PUNCT_RUN = r"([!?.,])\1+"
CHAR_RUN = r"(?d)(.)\1{2,}"
TOKEN = rf"[a-z]+(?:['’\-][a-z]+)*|<[a-z0-9_]+>|\p{{Nd}}+|[^{SPACE}]"
REFERENCE_NUMBER = r"^[#\-]?\p{Nd}(?:-*\p{Nd}){3,}-*$"      # four digits or more
CONTENT_WORD = r"^\p{L}{3,}$"

AUTOMATED = (r"(?iu)this is an automated (?:message|response|reply)"
             r"|do not reply to this (?:e-?mail|message)"
             r"|auto-?generated (?:message|response)"
             r"|your ticket (?:has been|was) (?:created|opened|logged) automatically"
             r"|out of office"
             r"|unsubscribe from these (?:e-?mails|notifications)")
# One of these is part of every match above.
AUTOMATED_NEEDLES = ("automated", "do not reply", "generated", "automatically",
                     "out of office", "unsubscribe")

GENERIC_SLOT = "<ph_details>"
INVOICE_SLOT = "<ph_invoice_number>"
TRACKING_SLOT = "<ph_tracking_number>"
REFUND_SLOT = "<ph_refund_amount>"
ORDER_SLOT = "<ph_order_number>"
INVOICE_CUE = "invoice|bill|billing"
TRACKING_CUE = "track|tracking|shipment|parcel|package"
REFUND_CUE = "refund|reimburse|money back"

SURFACES = {"<url>": "{{Website URL}}", "<email>": "{{Customer Support Email}}",
            "<user>": "there", "<num>": "{{Number}}", "<unk>": "",
            GENERIC_SLOT: "{{Details}}"}
GLUE_LEFT = list(".,!?;:%)]}")
GLUE_RIGHT = list("([{$#")
GLUE_BOTH = list("/@_")

CHAT_WORDS = {
    "u": "you", "ur": "your", "r": "are", "n": "and", "pls": "please",
    "plz": "please", "plss": "please", "thx": "thanks", "ty": "thank you",
    "tnx": "thanks", "cud": "could", "wud": "would", "shud": "should",
    "asap": "as soon as possible", "info": "information", "acct": "account",
    "acc": "account", "ordr": "order", "recieve": "receive", "recieved": "received",
    "adress": "address", "cancl": "cancel", "cancle": "cancel", "refnd": "refund",
    "paymnt": "payment", "im": "i am", "ive": "i have", "dont": "do not",
    "cant": "can not", "wont": "will not", "didnt": "did not", "doesnt": "does not",
    "isnt": "is not", "wasnt": "was not", "couldnt": "could not",
    "wouldnt": "would not", "shouldnt": "should not", "havent": "have not",
    "hasnt": "has not", "id": "i would", "ill": "i will", "wanna": "want to",
    "gonna": "going to", "gotta": "got to", "bcoz": "because", "bcz": "because",
    "coz": "because", "b4": "before", "msg": "message", "acnt": "account",
}

STOPWORDS = """
a an the this that these those i me my mine myself we our ours us you your
yours he him his she her hers it its they them their theirs is am are was were
be been being do does did doing done have has had having can could will would
shall should may might must of in on at to for with about from by as into over
under again further and or but if then else than so not no nor too very just
now here there when where why how what which who whom whose all any both each
few more most other some such only own same s t don dont cant im ive ill id
please pls hey hi hello thanks thank ok okay yes yeah still want need get got
""".split()

REFUSAL = (
    "I'm sorry, I'm not able to help with that one. I'm a customer-support "
    "assistant and I can answer questions about orders, refunds, payments, "
    "invoices, shipping and delivery, subscriptions, account access and "
    "contacting a human agent. Could you rephrase your question around one of "
    "those topics, or type 'agent' and I'll hand you over to a colleague?"
)

OUT_OF_DOMAIN = (
    "what is the boiling point of water on mars",
    "write me a python function that sorts a list",
    "who won the football world cup in 1998",
    "can you tell me a joke about penguins",
    "what should i cook for dinner tonight",
    "explain the theory of general relativity",
)

QUERY_COLUMNS = ("query", "question", "instruction", "message", "text", "customer_query")
EXPECTED_ROWS = 26872
# --- end of fixed values --------------------------------------------------------
