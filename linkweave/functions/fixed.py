"""Word lists, tables and patterns that results depend on."""

# Devanagari words and phrases and their Latin forms, replaced in this order.
DEVANAGARI_WORDS = {
    "प्राइवेट लिमिटेड": "private limited",
    "प्राइवेट लि.": "private limited",
    "प्रा. लि.": "pvt ltd",
    "प्रा.लि.": "pvt ltd",
    "प्रा लि": "pvt ltd",
    "प्राइवेट": "private",
    "लिमिटेड": "limited",
    "एलएलपी": "llp",
    "कंपनी": "company",
    "कॉर्पोरेशन": "corporation",
    "इंटरनेशनल": "international",
    "टेक्नोलॉजीज": "technologies",
    "टेक्नोलॉजी": "technology",
    "सॉल्यूशंस": "solutions",
    "एंटरप्राइजेज": "enterprises",
    "इंडस्ट्रीज": "industries",
    "सर्विसेज": "services",
    "इन्वेस्टमेंट्स": "investments",
    "इन्वेस्टमेंट": "investment",
    "कंस्ट्रक्शंस": "constructions",
    "कंस्ट्रक्शन": "construction",
    "डेवलपर्स": "developers",
    "मार्केटिंग": "marketing",
    "प्रॉपर्टीज": "properties",
    "वेंचर्स": "ventures",
    "इंजीनियरिंग": "engineering",
    "ट्रेडिंग": "trading",
    "फूड्स": "foods",
    "फूड": "food",
    "ग्लोबल": "global",
    "हेल्थकेयर": "healthcare",
    "इंफोटेक": "infotech",
    "सॉफ्टवेयर": "software",
    "मैनेजमेंट": "management",
    "कंसल्टेंट्स": "consultants",
    "कंसल्टिंग": "consulting",
    "फाइनेंस": "finance",
    "एनर्जी": "energy",
    "एक्सपोर्ट्स": "exports",
    "पावर": "power",
    "इंफ्रास्ट्रक्चर": "infrastructure",
    "इंफ्रा": "infra",
    "प्रोजेक्ट्स": "projects",
    "सिस्टम्स": "systems",
    "एग्रो": "agro",
    "प्रोडक्ट्स": "products",
    "प्रोड्यूसर": "producer",
    "इम्पेक्स": "impex",
    "बिजनेस": "business",
    "बिल्डर्स": "builders",
    "फाउंडेशन": "foundation",
    "एस्टेट": "estate",
    "महाराष्ट्र": "maharashtra",
    "कर्नाटक": "karnataka",
    "गुजरात": "gujarat",
    "राजस्थान": "rajasthan",
    "पंजाब": "punjab",
    "हरियाणा": "haryana",
    "उत्तर प्रदेश": "uttar pradesh",
    "मध्य प्रदेश": "madhya pradesh",
    "पश्चिम बंगाल": "west bengal",
    "तमिलनाडु": "tamil nadu",
    "केरल": "kerala",
    "आंध्र प्रदेश": "andhra pradesh",
    "तेलंगाना": "telangana",
    "दिल्ली": "delhi",
    "नई दिल्ली": "new delhi",
    "मुंबई": "mumbai",
    "पुणे": "pune",
    "नासिक": "nashik",
    "नागपुर": "nagpur",
    "कोलकाता": "kolkata",
    "बेंगलुरु": "bengaluru",
    "बैंगलोर": "bangalore",
    "चेन्नई": "chennai",
    "हैदराबाद": "hyderabad",
    "अहमदाबाद": "ahmedabad",
    "सूरत": "surat",
    "जयपुर": "jaipur",
    "लखनऊ": "lucknow",
    "भोपाल": "bhopal",
    "इंदौर": "indore",
    "पटना": "patna",
    "चंडीगढ़": "chandigarh",
}

# Latin forms of single Devanagari code points.
DEVANAGARI_LETTERS = {
    "अ": "a", "आ": "aa", "इ": "i", "ई": "ee", "उ": "u", "ऊ": "oo", "ऋ": "ri", "ए": "e", "ऐ": "ai", "ओ": "o", "औ": "au",
    "ा": "a", "ि": "i", "ी": "ee", "ु": "u", "ू": "oo", "ृ": "ri", "े": "e", "ै": "ai", "ो": "o", "ौ": "au",
    "ं": "n", "ँ": "n", "ः": "h", "्": "", "़": "", "ॅ": "e", "ॉ": "o", "॑": "", "॒": "",
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "ng", "च": "ch", "छ": "chh", "ज": "j", "झ": "jh", "ञ": "ny",
    "ट": "t", "ठ": "th", "ड": "d", "ढ": "dh", "ण": "n", "त": "t", "थ": "th", "द": "d", "ध": "dh", "न": "n",
    "प": "p", "फ": "ph", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ल": "l", "व": "v", "श": "sh",
    "ष": "sh", "स": "s", "ह": "h",
    "क़": "q", "ख़": "kh", "ग़": "gh", "ज़": "z", "ड़": "r", "ढ़": "rh", "फ़": "f",
    "०": "0", "१": "1", "२": "2", "३": "3", "४": "4", "५": "5", "६": "6", "७": "7", "८": "8", "९": "9",
}

# Legal forms, first match wins, and the words that removal takes out.
LEGAL_FORMS = [
    ("pvt ltd", r"pvt\s+ltd|private\s+limited|pvt\s+limited|private\s+ltd"),
    ("llc", "llc"),
    ("llp", "llp"),
    ("inc", "inc|incorporated"),
    ("corp", "corp|corporation"),
    ("ltd", "ltd|limited"),
    ("pvt", "pvt|private"),
    ("gmbh", "gmbh"),
    ("sarl", "sarl"),
    ("sas", "sas"),
    ("sci", "sci"),
    ("co", "co|company"),
]
LEGAL_WORDS = (
    r"pvt\s+ltd|private\s+limited|pvt\s+limited|private\s+ltd|corp|corporation|pvt|private|ltd|limited|llc|llp|inc|incorporated|sarl|sas|sci|gmbh|co|company"
)

# Mail providers that are no company's domain.
MAIL_DOMAINS = ["gmail", "yahoo", "hotmail", "outlook", "rediffmail", "aol", "icloud", "live", "ymail", "msn", "mail", "zoho"]
MAIL_DOMAINS_SHORT = ["gmail", "yahoo", "hotmail", "outlook", "aol", "icloud", "me", "msn", "live", "ymail", "rediffmail"]

# Top-level domains of a domain root.
DOMAIN_ENDINGS = "com|net|org|in|co|us|biz|info|io|fr|gov|edu"
DOMAIN_ENDINGS_SHORT = "com|org|net|in|co|us|biz|info|io|fr"

# Words without weight in a name, by profile.
FEATURE_SUFFIXES = [
    "inc", "incorporated", "corp", "corporation", "llc", "ltd", "limited", "pvt", "private", "co", "company", "sarl", "sa", "sas", "societe", "snc", "scs", "sca",
    "services", "enterprises", "industries", "group", "holdings", "solutions", "international", "tech", "technologies", "trading", "agency", "associates", "consulting", "gmbh", "llp",
]
BASELINE_SUFFIXES = ["corp", "corporation", "pvt", "private", "ltd", "limited", "llc", "inc", "gmbh", "co", "company"]
BUSINESS_SUFFIXES = ["inc", "corp", "corporation", "llc", "ltd", "limited", "pvt", "private", "co", "company", "sarl", "sa"]
BLOCKING_SUFFIXES = [*BUSINESS_SUFFIXES, "services", "enterprises", "industries", "group", "holdings", "solutions"]
PROFILED_SUFFIXES = ["inc", "llc", "corp", "corporation", "ltd", "limited", "pvt", "private", "co", "company", "services"]

# Shares of clusters of 0 to 10 matches, in percent.
CLUSTER_SHARES = [5.6, 5.4, 17.0, 24.2, 22.0, 14.5, 7.5, 3.0, 0.9, 0.2, 0.1]

# Fixed value: characters that a list of ids must not hold.
FORBIDDEN_IN_LIST = r"""[ \t"'\[\]{}()]"""
