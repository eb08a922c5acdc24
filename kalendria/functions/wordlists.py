"""Word lists and maps on which results depend, in their natural order."""

CATEGORIES = "AI ML DevOps Linux ChipDesign Math Legal ComputerScience Security Data Networking Robotics Bioinformatics".split()

CATEGORY_WORDS = {
    "AI": ["artificial intelligence", " ai ", "agentic", "llm", "neural"],
    "ML": ["machine learning", " ml ", "deep learning", "supervised"],
    "DevOps": ["devops", "ci/cd", "kubernetes", "platform engineering"],
    "Linux": ["linux", "kernel", "systemd", "open source"],
    "ChipDesign": ["chip design", "vlsi", "asic", "fpga", "rtl", "verilog"],
    "Math": ["mathematics", "topology", "algebra", "combinatorics"],
    "Legal": ["legal", "law", "regulation", "compliance"],
    "ComputerScience": ["computer science", "algorithms", "complexity"],
    "Security": ["security", "cryptography", "infosec", "vulnerability"],
    "Data": ["data engineering", "data science", "analytics", "warehouse"],
    "Networking": ["networking", "tcp", "sdn", "5g", "wireless"],
    "Robotics": ["robotics", "manipulation", "slam", "autonomous"],
    "Bioinformatics": ["bioinformatics", "genomics", "proteomics", "biology"],
}

VIRTUAL_WORDS = ["online", "virtual", "remote", "zoom", "webinar", "fully online"]

CONFERENCE_SIGNALS = ["call for papers", "cfp", "submission deadline", "paper deadline", "workshop", "symposium", "conference"]

ONLINE = ["online", "virtual", "remote", "zoom", "webinar", "web-based", "everywhere"]

UK = [
    "united kingdom", ", uk", " uk,", "(uk)", "uk.", "england", "scotland", "wales", "london", "manchester", "oxford", "cambridge", "edinburgh", "glasgow", "birmingham",
    "bristol", "leeds", "sheffield", "liverpool", "newcastle", "nottingham", "southampton", "exeter", "bath",
]

SWITZERLAND = "switzerland swiss zurich zürich zuerich geneva genève geneve basel bern lausanne lugano davos lucerne luzern montreux winterthur".split()

EUROPE = [
    "france", "germany", "spain", "italy", "netherlands", "belgium", "sweden", "norway", "denmark", "finland", "austria", "poland", "czech", "portugal", "greece",
    "hungary", "ireland", "luxembourg", "malta", "croatia", "romania", "bulgaria", "slovakia", "slovenia", "estonia", "latvia", "lithuania", "cyprus", "paris", "berlin",
    "madrid", "rome", "amsterdam", "brussels", "stockholm", "vienna", "oslo", "copenhagen", "helsinki", "lisbon", "athens", "dublin", "warsaw", "prague", "budapest",
    "bucharest", "europe", "european",
]

USA = [
    "united states", ", usa", " usa,", "u.s.a", "(usa)", "new york", "san francisco", "los angeles", "chicago", "boston", "seattle", "austin", "denver", "atlanta",
    "houston", "dallas", "washington dc", "washington d.c", "san diego", "las vegas", "philadelphia", "orlando", "miami", "portland", "minneapolis", "pittsburgh",
    "salt lake city", "nashville", "phoenix", "san jose", "santa clara", "palo alto", "menlo park", ", ca,", ", ca.", ", ny,", ", ny.", ", tx,", ", wa,", ", ma,",
    ", il,", ", ga,", ", co,", ", fl,", ", va,", ", pa,", ", oh,", ", nc,", ", az,", ", or,",
]

SINGAPORE = ["singapore"]

#: Cities by state of India.
STATE_CITIES = {
    "Maharashtra": ["mumbai", "pune", "nagpur", "nashik", "aurangabad", "kolhapur", "solapur", "navi mumbai"],
    "Karnataka": ["bangalore", "bengaluru", "mysore", "mysuru", "mangalore", "hubli", "dharwad", "belagavi", "belgaum"],
    "Tamil Nadu": ["chennai", "coimbatore", "madurai", "trichy", "tiruchirappalli", "vellore", "salem", "tirunelveli", "thanjavur"],
    "Delhi": ["delhi", "new delhi"],
    "Telangana": ["hyderabad", "secunderabad", "warangal", "karimnagar"],
    "West Bengal": ["kolkata", "calcutta", "siliguri", "durgapur"],
    "Gujarat": ["ahmedabad", "surat", "vadodara", "baroda", "rajkot", "gandhinagar"],
    "Rajasthan": ["jaipur", "jodhpur", "udaipur", "ajmer", "kota", "bikaner"],
    "Madhya Pradesh": ["bhopal", "indore", "gwalior", "jabalpur"],
    "Uttar Pradesh": ["lucknow", "kanpur", "varanasi", "agra", "allahabad", "prayagraj", "noida", "ghaziabad", "meerut", "mathura"],
    "Bihar": ["patna", "gaya", "muzaffarpur"],
    "Jharkhand": ["ranchi", "jamshedpur", "dhanbad"],
    "Odisha": ["bhubaneswar", "bhubaneshwar", "cuttack"],
    "Kerala": ["thiruvananthapuram", "trivandrum", "kochi", "cochin", "kozhikode", "calicut", "thrissur"],
    "Chandigarh": ["chandigarh"],
    "Punjab": ["amritsar", "ludhiana", "jalandhar"],
    "Haryana": ["gurgaon", "gurugram", "faridabad", "panipat"],
    "Uttarakhand": ["dehradun", "roorkee", "haridwar"],
    "Himachal Pradesh": ["shimla", "manali"],
    "Jammu & Kashmir": ["srinagar", "jammu"],
    "Assam": ["guwahati", "dibrugarh"],
    "Manipur": ["imphal"],
    "Meghalaya": ["shillong"],
    "Tripura": ["agartala"],
    "Nagaland": ["kohima"],
    "Andhra Pradesh": ["visakhapatnam", "vizag", "vijayawada", "tirupati", "guntur"],
    "Chhattisgarh": ["raipur", "bilaspur"],
    "Goa": ["goa", "panaji"],
}

NO_STATE = "Other / Location Unspecified"

ESCALATION_REASONS = (
    "low_confidence json_parse_fail json_parse_failed tool_loop_exhausted model_unavailable long_context ambiguous extraction_failed "
    "multi_category unknown_site dedup_ambiguous dedup_collapsed ontology_edge quality_block"
).split()
