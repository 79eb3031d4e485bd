"""The words and patterns the classifiers know, and what they stand for.

Word families are compared with the whole label, regardless of case. ``OTHER`` is what an unlisted
label gets. Rule lists are tried from top to bottom and the first hit decides.
"""

from __future__ import annotations

# --- lead status: words, normalized status, funnel stage, (won, lost, active) --------------------
LEAD_STATUS = (
    (
        (
            "Needs to be contacted",
            "Needs to be contacted (FRESH)",
            "Needs to be contacted (Reassigned)",
            "Needs to be contacted Resale",
            "Call Center only (Unkown)",
        ),
        "to_contact", "TO_CONTACT", (0, 0, 1),
    ),
    (
        ("No answer", "No answer (First call)", "Switched off", "Client not available"),
        "no_answer", "CONTACT_ATTEMPT", (0, 0, 1),
    ),
    (
        (
            "Meeting scheduled",
            "Another Meeting scheduled",
            "Zoom meeting scheduled",
            "Another Zoom Meeting scheduled",
            "Confirm meeting",
        ),
        "meeting_scheduled", "MEETING_BOOKED", (0, 0, 1),
    ),
    (
        (
            "Meeting",
            "Physical Meeting happened",
            "Meeting Follow up",
            "Another Meeting Happened",
            "Zoom meeting happened",
            "Another Zoom meeting happened",
            "Presentation",
            "Presentation (ready to move)",
        ),
        "meeting_done", "MEETING_HELD", (0, 0, 1),
    ),
    (
        ("EOI", "Unit Blocked", "Unit Reserved", "Awaiting contract signing"),
        "reservation_stage", "RESERVATION", (0, 0, 1),
    ),
    (
        ("Contract Signed", "Rejected Contract", "Finalize deal", "Primary Buyer"),
        "contract_stage", "CONTRACT", (0, 0, 1),
    ),
    (("Congrats... It's a sale!",), "sale_won", "WON", (1, 0, 0)),
    (
        (
            "Wrong number",
            "Not a client",
            "Low budget",
            "Invalid location",
            "Bought outside",
            "Bought outside compound",
            "(Call Center Only) Rubbish",
            "Not interested",
        ),
        "disqualified", "DISQUALIFIED", (0, 1, 0),
    ),
    (("Reassigning", "Reassigned Handover"), "reassigned", "INTERNAL_REASSIGN", (0, 0, 1)),
    (("Meeting canceled",), "meeting_canceled", "MEETING_CANCELED", (0, 0, 1)),
)
LEAD_STATUS_OTHER = ("other", "OTHER", (0, 0, 1))

# --- lead type: words, group, commercial ---------------------------------------------------------
LEAD_TYPE = (
    (("Primary",), "PRIMARY", 0),
    (("Resale Buyer", "Seller"), "RESALE", 0),
    (("Nawy Now",), "INSTANT_BUY", 0),
    (("Commercial Buyer", "Commercial Seller", "Commercial Rental"), "COMMERCIAL", 1),
    (("Brokerage", "Freelancer", "Ambassador"), "REFERRAL_BROKER", 0),
)
LEAD_TYPE_OTHER = ("OTHER", 0)

# --- contact method: words, clean name, group, (digital, social, call center, offline, referral) --
CONTACT_METHOD = (
    (
        (
            "facebook", "facebook comment", "facebook message", "facebook page referral",
            "l.facebook.com", "form facebook",
        ),
        "facebook", "SOCIAL", (1, 1, 0, 0, 0),
    ),
    (("instagram", "instagram message"), "instagram", "SOCIAL", (1, 1, 0, 0, 0)),
    (("linkedin", "linkedin.com", "com.linkedin.android"), "linkedin", "SOCIAL", (1, 1, 0, 0, 0)),
    (("youtube",), "youtube", "SOCIAL", (1, 1, 0, 0, 0)),
    (
        (
            "google", "form google", "google lead form", "google,google", "r.search.yahoo.com",
            "search.yahoo.com", "bing.com", "timebusinessnews.com", "realitypaper.com",
            "magazines2day.com", "evokingminds.com", "amirarticles.com", "10bestseo.com",
            "www-cooingestate-com.cdn.ampproject.org", "newchat.ktree.org", "localhost",
        ),
        "search/web", "SEARCH_ORGANIC", (1, 0, 0, 0, 0),
    ),
    (("blog",), "blog", "SEARCH_ORGANIC", (0, 0, 0, 0, 0)),
    (
        (
            "generic form", "organic form", "top compounds form", "form", "type form",
            "resale form", "elite form", "generic contact us form",
        ),
        "website form", "WEBSITE_FORM", (1, 0, 0, 0, 0),
    ),
    (("website",), "other", "WEBSITE_FORM", (1, 0, 0, 0, 0)),
    (
        ("form adwords", "snapchat lead form", "dynamicremarketing", "criteo", "propertyfinder"),
        "paid ads form", "PAID_ADS", (1, 0, 0, 0, 0),
    ),
    (("nawy partners form",), "partner form", "BROKER_PARTNER", (0, 0, 0, 0, 0)),
    (
        ("app", "mobile_app", "app contact form", "ambassador app", "broker app"),
        "app", "APP", (1, 0, 0, 0, 0),
    ),
    (
        ("client referral", "management referral", "internal referral", "through friends"),
        "referral", "REFERRAL", (0, 0, 0, 0, 1),
    ),
    (("phone", "cold call", "sms"), "phone/sms", "PHONE_SMS", (0, 0, 0, 0, 0)),
    (("callcenter",), "call center", "CALL_CENTER", (0, 0, 1, 0, 0)),
    (
        ("walk-in", "corporate deals", "bay 7 event", "personal"),
        "offline", "OFFLINE", (0, 0, 0, 1, 0),
    ),
    (
        ("broker", "resale sheet", "amwaj sheet"),
        "broker/partner", "BROKER_PARTNER", (0, 0, 0, 0, 0),
    ),
    (("intercom", "owners portal"), "internal tool", "INTERNAL", (1, 0, 0, 0, 0)),
    (("generic list", "direct"), "other known", "OTHER", (0, 0, 0, 0, 0)),
    (("vodafone", "cpn vodafone 1"), "other known", "PHONE_SMS", (0, 0, 0, 0, 0)),
    (("(none)", "test", "2024-06-19 00:00:00"), "unknown", "UNKNOWN", (0, 0, 0, 0, 0)),
)
CONTACT_METHOD_OTHER = ("other", "OTHER", (0, 0, 0, 0, 0))

# --- lead source: words and LIKE patterns (``_`` matches any one character) -----------------------
SEARCH_SITES = (
    "search.yahoo.com", "r.search.yahoo.com", "bing.com", "magazines2day.com", "amirarticles.com",
    "evokingminds.com", "realitypaper.com", "10bestseo.com", "timebusinessnews.com",
)
PARTNER_SOURCES = ("broker", "broker app", "nawy partners form", "resale sheet", "amwaj sheet")
OFFLINE_SOURCES = (
    "walk-in", "bay 7 event", "corporate deals", "hotline", "phone", "sms", "callcenter",
    "call center resale",
)
INTERNAL_SOURCES = ("intercom", "owners portal", "old cooing client")
ORGANIC_WORDS = ("organic", "organic form", "organic search")
DIRECT_WORDS = ("direct", "direct traffic", "(none)", "unknown")
PAID_WORDS = ("paid search", "googleads.g.doubleclick.net", "google_ads", "dynamicremarketing", "criteo")

SITE_PATTERNS = ("%website%", "%landing page%", "%form%")
REFERRAL_PATTERNS = ("%referral%", "%through friends%", "%cooing client referral%")
SOCIAL_PATTERNS = ("%facebook%", "%instagram%", "%youtube%", "%linkedin%")
PAID_PATTERNS = ("%cpc%", "%paid%")

# (answer, words, patterns)
LEAD_SOURCE_CLEAN = (
    ("unknown", ("",), ()),
    ("facebook", (), ("%facebook%",)),
    ("instagram", (), ("%instagram%",)),
    ("youtube", (), ("%youtube%",)),
    ("whatsapp", (), ("whatsapp%",)),
    (
        "google/search",
        ("form google", *SEARCH_SITES),
        ("google%", "%google.com%", "%google_ads%", "%googleads.g.doubleclick.net%"),
    ),
    ("propertyfinder", (), ("%propertyfinder%",)),
    ("website/form", ORGANIC_WORDS, SITE_PATTERNS),
    ("broker/partner", PARTNER_SOURCES, ()),
    ("referral", (), REFERRAL_PATTERNS),
    ("internal", INTERNAL_SOURCES, ()),
    ("offline", OFFLINE_SOURCES, ()),
    ("direct/unknown", DIRECT_WORDS, ()),
)
LEAD_SOURCE_GROUP = (
    ("SOCIAL", (), SOCIAL_PATTERNS),
    ("SEARCH", SEARCH_SITES, ("google%", "%google.com%")),
    ("OWNED_MEDIA", ORGANIC_WORDS, SITE_PATTERNS),
    ("PORTAL", (), ("%propertyfinder%",)),
    ("PARTNER", PARTNER_SOURCES, ()),
    ("REFERRAL", (), REFERRAL_PATTERNS),
    ("OFFLINE", OFFLINE_SOURCES, ()),
    ("INTERNAL", INTERNAL_SOURCES, ()),
    ("MESSAGING", (), ("whatsapp%",)),
)
LEAD_SOURCE_FLAGS = {
    "is_social": ((), SOCIAL_PATTERNS),
    "is_partner": (PARTNER_SOURCES, ()),
    "is_offline": (OFFLINE_SOURCES, ()),
    "is_organic": (ORGANIC_WORDS, ("%organic%",)),
    "is_paid": (PAID_WORDS, PAID_PATTERNS),
}

# --- campaign ------------------------------------------------------------------------------------
CAMPAIGN_JUNK = ("", "0", "(none)")
CAMPAIGN_UNKNOWN = "Unknown"
CAMPAIGN_REPLACEMENTS = (("%20", " "), ("  ", " "))
CAMPAIGN_TYPE = (
    ("REMARKETING", (), ("%remarket%",)),
    ("BRAND", (), ("%brand%",)),
    ("PROSPECTING", (), ("%prospect%",)),
    ("SMS", (), ("%sms%",)),
    ("PERFORMANCE_DISPLAY", (), ("%pmax%", "%display%", "%retarget%", "%demandgen%")),
)
CAMPAIGN_FLAGS = {
    "is_brand": ((), ("%brand%",)),
    "is_remarketing": ((), ("%remarket%",)),
}

# --- property type: words, group, (residential, commercial, vacation) -----------------------------
PROPERTY_TYPE = (
    (
        ("APARTMENT", "DUPLEX", "PENTHOUSE", "STUDIO", "SERVICED APARTMENT", "FAMILY HOUSE"),
        "RESIDENTIAL_APT", (1, 0, 0),
    ),
    (("VILLA", "TOWNHOUSE", "TWINHOUSE"), "RESIDENTIAL_VILLA", (1, 0, 0)),
    (("CHALET", "CABIN"), "VACATION", (0, 0, 1)),
    (("OFFICE", "RETAIL", "CLINIC"), "COMMERCIAL", (0, 1, 0)),
)
PROPERTY_TYPE_OTHER = ("OTHER", (0, 0, 0))

# --- sale category: words, group, (primary, resale, developer, instant buy) -----------------------
SALE_CATEGORY = (
    (("Primary",), "PRIMARY", (1, 0, 0, 0)),
    (("Resale Buyer", "Resale Seller"), "RESALE", (0, 1, 0, 0)),
    (("Developer Resale",), "RESALE", (0, 1, 1, 0)),
    (("Developer Commercial Sale",), "DEVELOPER_COMMERCIAL", (0, 0, 1, 0)),
    (("Nawy Now",), "INSTANT_BUY", (0, 0, 0, 1)),
)
SALE_CATEGORY_OTHER = ("OTHER", (0, 0, 0, 0))
SALE_CATEGORY_UNKNOWN = "Unknown"

# --- calendar ------------------------------------------------------------------------------------
CALENDAR_START = "2010-01-01"
CALENDAR_END = "2040-12-31"
WEEKEND_DAYS = (6, 7)  # Friday and Saturday, where Sunday is day 1
