"""Dictionaries of this library's own; the longer ones are put together by rule."""

_FIRST_PARTS = ["Ash", "Bar", "Black", "Brad", "Cald", "Clay", "Den", "El", "Fair", "Fen", "Gar", "Had", "Hart", "Ing", "Ken", "Lang", "Mar", "Nor", "Oak",
                "Pem", "Rad", "Sel", "Thorn", "Up", "Wex"]
_LAST_PARTS = ["wood", "ford", "ley", "well", "ton", "worth", "bridge", "field", "holm", "more", "brook", "stead", "by", "hurst", "combe", "den"]
#: Every first part with every last one: the most usual endings come first.
LAST_NAMES = [a + b for b in _LAST_PARTS for a in _FIRST_PARTS]
FIRST_NAMES = {
    "F": ["Alice", "Beth", "Clara", "Diana", "Edith", "Flora", "Grace", "Helen", "Iris", "Judith", "Karen", "Laura", "Marion", "Nora", "Olive", "Paula",
          "Agnes", "Bridget", "Cecily", "Dorothy", "Elsie", "Frances", "Greta", "Harriet", "Ingrid", "Joan", "Kathleen", "Lydia", "Mabel", "Nina", "Opal",
          "Phoebe", "Rachel", "Sylvia", "Thelma", "Ursula", "Vera", "Winifred", "Yvonne", "Zelda", "Amelia", "Barbara", "Celia", "Daphne", "Eleanor", "Freda",
          "Gloria", "Hazel"],
    "M": ["Adam", "Brian", "Carl", "Daniel", "Edgar", "Frank", "George", "Henry", "Isaac", "Jacob", "Kevin", "Lewis", "Martin", "Neil", "Oscar", "Peter",
          "Albert", "Bernard", "Clement", "Douglas", "Edwin", "Felix", "Gordon", "Harold", "Ivan", "Julian", "Kenneth", "Leonard", "Maurice", "Norman", "Owen",
          "Philip", "Ralph", "Stanley", "Theodore", "Ulric", "Victor", "Walter", "Xavier", "Zachary", "Alfred", "Benedict", "Conrad", "Dennis", "Ernest",
          "Francis", "Gilbert", "Hugh"],
}
_STREETS = ["Birch", "Cedar", "Dogwood", "Elm", "Fern", "Grove", "Hazel", "Ivy", "Juniper", "Laurel", "Maple", "Oak", "Pine", "Quince", "Rowan", "Spruce",
            "Tulip", "Violet", "Willow", "Yew"]
_KINDS = ["Street", "Avenue", "Lane", "Road", "Court", "Drive", "Way", "Place", "Terrace"]
#: (city, state, the first three digits of its codes)
_PLACES = [("Ashford", "CA", "900"), ("Brookfield", "CA", "904"), ("Clearwater", "TX", "733"), ("Deerfield", "NY", "100"), ("Eastport", "ME", "046"),
           ("Fairview", "OR", "970"), ("Glenwood", "WA", "980"), ("Hillsboro", "OH", "451"), ("Ironwood", "MI", "499"), ("Jamestown", "ND", "584"),
           ("Kingston", "NY", "124"), ("Lakeside", "AZ", "859"), ("Milford", "UT", "847"), ("Newport", "VT", "058"), ("Oakdale", "LA", "714"),
           ("Pinehurst", "ID", "838"), ("Riverton", "WY", "825"), ("Salem", "VA", "241"), ("Troy", "MT", "599"), ("Union", "SC", "293"), ("Vernon", "AL", "355"),
           ("Weston", "MO", "640"), ("York", "NE", "684")]
#: (street, type, city, state, zip): 240 of them, all parts going round at their own pace.
ADDRESSES = [(_STREETS[i % 20], _KINDS[i % 9], c, st, f"{z}{i % 89 + 10}") for i in range(240) for c, st, z in [_PLACES[i % 23]]]
CITIES = sorted({a[2] for a in ADDRESSES} | {"Boston", "Chicago", "Denver", "Houston", "Oakland", "Palo Alto", "Portland", "Sacramento", "San Francisco", "Seattle"})
#: Street types and what they are shortened to.
STREET_TYPES = {
    "Street": ["St"], "Avenue": ["Ave", "Av"], "Road": ["Rd"], "Drive": ["Dr"], "Lane": ["Ln"], "Court": ["Ct"], "Boulevard": ["Blvd"], "Place": ["Pl"],
    "Terrace": ["Ter"], "Circle": ["Cir"], "Highway": ["Hwy"], "Parkway": ["Pkwy"], "Square": ["Sq"], "Trail": ["Trl"], "Way": [], "Alley": ["Aly"], "Loop": [],
}
COMPASS = ["North", "South", "East", "West", "NE", "NW", "SE", "SW", "N", "S", "E", "W"]
UNITS = ["Apartment", "Apt", "Unit", "Suite", "Ste", "Room", "Rm", "Floor", "Fl", "#"]
#: Words that stand in fields of known values without telling anything of a person.
IGNORED_WORDS = [
    "and", "at", "by", "for", "in", "of", "on", "or", "the", "to", "with", "unknown", "none", "street", "road", "avenue", "apt",
    "a", "an", "as", "be", "but", "from", "is", "it", "no", "not", "than", "that", "this", "was", "were", "will", "are", "has", "have", "had", "into", "per",
    "lane", "drive", "court", "place", "way", "terrace", "suite", "unit", "floor", "building", "box", "north", "south", "east", "west", "upper", "lower", "new",
    "day", "week", "month", "year", "home", "work", "cell", "phone", "mobile", "fax", "email", "mail", "contact", "address", "city", "state", "zip", "country",
    "name", "first", "last", "middle", "maiden", "patient", "person", "family", "other", "self", "spouse", "parent", "mother", "father", "child", "relative",
    "male", "female", "yes", "true", "false", "na", "tbd", "test", "blank", "empty", "missing", "declined", "refused", "pending", "see", "note", "chart",
]

# States and their codes, titles and pronouns that are no names.
STATES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA", "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS",
    "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN",
    "Mississippi": "MS", "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ",
    "New Mexico": "NM", "New York": "NY", "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR",
    "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT",
    "Vermont": "VT", "Virginia": "VA", "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY", "District of Columbia": "DC",
}
COUNTRIES = [
    "Argentina", "Australia", "Austria", "Bangladesh", "Belgium", "Brazil", "Bulgaria", "Cambodia", "Canada", "Chile", "China", "Colombia",
    "Costa Rica", "Croatia", "Cuba", "Czechia", "Denmark", "Ecuador", "Egypt", "Ethiopia", "Finland", "France", "Germany", "Ghana", "Greece",
    "Guatemala", "Haiti", "Honduras", "Hungary", "Iceland", "India", "Indonesia", "Iran", "Iraq", "Ireland", "Israel", "Italy", "Jamaica", "Japan",
    "Jordan", "Kenya", "Laos", "Lebanon", "Malaysia", "Mexico", "Morocco", "Nepal", "Netherlands", "New Zealand", "Nicaragua", "Nigeria", "Norway",
    "Pakistan", "Panama", "Peru", "Philippines", "Poland", "Portugal", "Romania", "Russia", "Saudi Arabia", "Senegal", "Serbia", "Singapore",
    "Slovakia", "Somalia", "South Africa", "South Korea", "Spain", "Sri Lanka", "Sudan", "Sweden", "Switzerland", "Syria", "Taiwan", "Tanzania",
    "Thailand", "Tunisia", "Turkey", "Uganda", "Ukraine", "United Kingdom", "United States", "Uruguay", "Venezuela", "Vietnam", "Yemen", "Zambia",
    "Zimbabwe",
]
TITLES = ["MD", "MR", "MS", "MRS", "MISS", "MASTER", "MAID", "MADAM", "AUNT", "AUNTIE", "UNCLE", "DR", "professor", r"PROF\.?", r"DOC\.?", "DOCTOR",
          "Docent", "PhD", "Dphil", "DBA", "EdD", "PharmD", "LLD", "HE", "HIM", "HIS", "HER", "SHE", "HERS", "THEY", "THEM", "THEIR", "THEIRS"]
