"""Typed settings and fixed values. Nothing reads the clock: every run passes ``as_of``."""

from __future__ import annotations

from dataclasses import dataclass, field

# Closed vocabularies of the data model, in their natural order.
CATEGORIES = ["live_music", "club_nightlife", "theatre_performance", "comedy", "art_exhibitions", "film_cinema", "talks_literature", "workshops_classes", "markets_fairs", "food_drink", "festivals", "sports_fitness", "family_kids", "community_causes", "other"]
LABELS = {
    "live_music": "Live Music",
    "club_nightlife": "Club & Nightlife",
    "theatre_performance": "Theatre & Performance",
    "comedy": "Comedy",
    "art_exhibitions": "Art & Exhibitions",
    "film_cinema": "Film & Cinema",
    "talks_literature": "Talks & Literature",
    "workshops_classes": "Workshops & Classes",
    "markets_fairs": "Markets & Fairs",
    "food_drink": "Food & Drink",
    "festivals": "Festivals",
    "sports_fitness": "Sports & Fitness",
    "family_kids": "Family & Kids",
    "community_causes": "Community & Causes",
    "other": "Other",
}
SCHEMA_TYPES = {
    "MusicEvent": "live_music",
    "TheaterEvent": "theatre_performance",
    "PerformingArtsEvent": "theatre_performance",
    "ComedyEvent": "comedy",
    "ExhibitionEvent": "art_exhibitions",
    "VisualArtsEvent": "art_exhibitions",
    "ScreeningEvent": "film_cinema",
    "LiteraryEvent": "talks_literature",
    "PublicationEvent": "talks_literature",
    "EducationEvent": "workshops_classes",
    "CourseInstance": "workshops_classes",
    "SaleEvent": "markets_fairs",
    "FoodEvent": "food_drink",
    "Festival": "festivals",
    "SportsEvent": "sports_fitness",
    "ChildrensEvent": "family_kids",
    "BusinessEvent": "community_causes",
    "ConferenceEvent": "community_causes",
    "Hackathon": "community_causes",
    "SocialEvent": "community_causes",
}
# Preference among families with equal counts, and among sources for a cluster's head.
FAMILY_PRIORITY = ["comedy", "film_cinema", "markets_fairs", "talks_literature", "workshops_classes", "art_exhibitions", "theatre_performance", "family_kids", "sports_fitness", "food_drink", "live_music", "club_nightlife", "festivals", "community_causes"]
SOURCE_PRIORITY = {"kulturdaten": 0, "ra": 1, "ticketmaster": 2, "berlin_de": 3, "vhs": 4, "eventbrite": 5, "livegigs": 6, "rausgegangen": 7, "tip_berlin": 8, "gratis_berlin": 9}
LAST_PRIORITY = 99
# Keyword families (German and English), case-insensitive, as Java regular expressions.
FAMILIES: dict[str, list[str]] = {
    "live_music": ["konzert", "live[- ]?musik", "live: ", r"gig\b", "unplugged", "akustik(?:abend|konzert)", "support[:]?", r"tournee|tour \d{4}"],
    "club_nightlife": ["party", "rave", "clubnacht", "club night", "dj[- ]?set", r"djs?\b", r"techno|house music|drum ?& ?bass|dnb\b", "afterhour", "open decks"],
    "theatre_performance": ["premiere", "bühne|buehne", "theater(?!haus)|theatre", "schauspiel", "tanzstück|tanzstueck", "ballett|ballet", r"oper\b|opera", "performance(?:kunst)?", "puppentheater", "burlesque|burleske", "varieté|variete|variety ?show", "cabaret", "revue", r"pantomime|\bmime\b", "drag[- ]?show", "zirkus|circus"],
    "comedy": ["comedy", "stand[- ]?up", "kabarett", "impro(?:visations)?[- ]?(?:show|theater|comedy)", "open mic comedy"],
    "art_exhibitions": ["ausstellung", "vernissage", "finissage", "galerie|gallery", "exhibition", r"kunstwerke?\b", "museumsnacht"],
    "film_cinema": ["kino", "filmvorführung|filmvorfuehrung", "screening", "kurzfilm", "open[- ]?air[- ]?kino", "dokumentarfilm"],
    "talks_literature": ["lesung", "vortrag", r"talk\b", "panel", "diskussion", "buchpremiere", "poetry ?slam", "autorenlesung"],
    "workshops_classes": ["workshop", r"kurs\b", "seminar", "tanzkurs", "masterclass", "schreibwerkstatt"],
    "markets_fairs": ["flohmarkt", "trödelmarkt|troedelmarkt", r"markt\b", "designmarkt", r"messe\b", "basar|bazaar", r"fair\b"],
    "food_drink": ["tasting", "verkostung", "weinprobe", "street ?food", "brunch", r"dinner\b", "kulinarisch"],
    "festivals": ["festival", "festspiele"],
    "sports_fitness": [r"lauf\b|marathon", "yoga", "turnier", "spieltag", "bouldern|klettern", "fitness"],
    "family_kids": [r"kinder\b", r"familien?\b", "puppenshow", "märchen|maerchen", "mitmach"],
    "community_causes": ["meetup", "netzwerk(?:en|treffen)|networking", r"demo(?:nstration)?\b", "kundgebung", "kiezfest", "gottesdienst", "stammtisch", "hackathon"],
}
TAG_FAMILIES: dict[str, list[str]] = {
    "open-air": ["open[- ]?air", "draußen|draussen", "unter freiem himmel"],
    "family-friendly": ["familienfreundlich", "für die ganze familie", "kinder willkommen"],
    "queer": ["queer", "lgbtq?", r"drag\b", r"csd\b"],
}
# Schema.org statuses and attendance modes by the last part of their address, lower case.
STATUSES = {"eventscheduled": "scheduled", "eventcancelled": "cancelled", "eventpostponed": "postponed", "eventrescheduled": "rescheduled", "eventmovedonline": "scheduled"}
MODES = {"offlineeventattendancemode": "offline", "onlineeventattendancemode": "online", "mixedeventattendancemode": "mixed"}
RECORD_HOSTS = ["api-v2.kulturdaten.berlin"]
# Fixed value: the city's box, latitude then longitude.
BOXES = {"berlin": (52.30, 52.70, 12.90, 13.80)}


# List fields of the published feed, in their order; fields of one slot in a detail object; the shape's version.
LIST_FIELDS = [
    "id", "event_id", "city", "title", "category", "category_label", "tags", "starts_at_utc", "starts_at_local", "ends_at_utc", "doors_at_local", "nightlife_date", "time_unknown", "is_range", "range_start", "range_end",
    "event_status", "venue_name", "address", "geo", "price", "image_url", "image_attribution", "placeholder_url", "source", "source_url", "source_is_record", "series_key", "first_seen_at", "h",
]
SLOT_FIELDS = ["doors_at_local", "ends_at_utc", "event_status", "id", "nightlife_date", "starts_at_local", "starts_at_utc", "time_unknown"]
SCHEMA_VERSION = 2
# Words for stand-in pictures of a category.
PLACEHOLDER_WORDS = {
    "live_music": "concert,band", "club_nightlife": "nightclub,dj", "theatre_performance": "theatre,stage", "comedy": "standup,microphone", "art_exhibitions": "art,gallery", "film_cinema": "cinema", "talks_literature": "books,lecture",
    "workshops_classes": "workshop", "markets_fairs": "fleamarket,market", "food_drink": "streetfood", "festivals": "festival,crowd", "sports_fitness": "sports", "family_kids": "carousel,playground", "community_causes": "community,people", "other": "berlin,city",
}
# Sources of one category, sources cheap enough for a run between, sources whose own listing tells what is
# gone, and hosts whose pages are not visited for links or for pictures.
SOURCE_PRIORS = {"ra": "club_nightlife", "comedy_in_english": "comedy", "comedy_cafe": "comedy", "prinzipal": "theatre_performance", "vhs": "workshops_classes"}
CHEAP = ["kulturdaten", "berlin_de", "ra"]
SELF_LISTING = ["kulturdaten", "ra", "vhs"]
NO_LINK_CHECK = ["ra.co", "api-v2.kulturdaten.berlin"]
NO_IMAGE_SCAN = ["ra.co", "api-v2.kulturdaten.berlin", "app.ticketmaster.com", "vhsit.berlin.de"]
CITY_SOURCES = {"berlin": ["kulturdaten", "berlin_de", "vhs", "prinzipal", "ticketmaster", "ra", "tip_berlin", "livegigs", "comedy_in_english", "comedy_cafe", "rausgegangen", "eventbrite"]}
ALWAYS_DENIED = ("ticketmaster.de",)


@dataclass(frozen=True)
class Policy:
    """What a source permits."""

    slug: str
    status: str = "active"  # active, needs_permission or stop
    domains: tuple[str, ...] = ()
    description: bool = False
    images: bool = False
    licence: str | None = None
    attribution: str | None = None
    name: str | None = None
    homepage: str | None = None
    access: str | None = None
    licence_url: str | None = None
    terms_url: str | None = None


# What each source permits, and how it is credited.
_CC_BY = "https://opendefinition.org/licenses/cc-by/"
POLICIES = (
    Policy("kulturdaten", "active", ("kulturdaten.berlin",), name="kulturdaten.berlin", homepage="https://www.kulturdaten.berlin/", access="open-data API (keyless)", terms_url="https://www.kulturdaten.berlin/", attribution="Event data: kulturdaten.berlin (Technologiestiftung Berlin), from the berlin.de district event calendar"),
    Policy("berlin_de", "active", description=True, name="Berlin.de — Märkte und Feste", homepage="https://www.berlin.de/sen/web/service/maerkte-feste/", access="open-data JSON", licence="CC BY", licence_url=_CC_BY, terms_url="https://www.berlin.de/robots.txt", attribution="Senatsverwaltung für Wirtschaft, Energie und Betriebe / Berlin.de (Berlin Open Data, CC BY)"),
    Policy("vhs", "active", description=True, name="Berliner Volkshochschulen", homepage="https://www.berlin.de/vhs/", access="open-data JSON", licence="CC BY", licence_url=_CC_BY, terms_url="https://datenregister.berlin.de/api/3/action/package_show?id=kurse", attribution="Servicezentrum der Berliner Volkshochschulen (Berlin Open Data, CC BY)"),
    Policy("ticketmaster", "active", images=True, name="Ticketmaster", homepage="https://www.ticketmaster.de/", access="Discovery API (key)", licence="Ticketmaster Developer Terms of Use", terms_url="https://developer.ticketmaster.com/support/terms-of-use/", attribution="Event data and images: Ticketmaster"),
    Policy("prinzipal", "needs_permission", ("prinzipal-kreuzberg.com",), name="Prinzipal Kreuzberg", homepage="https://prinzipal-kreuzberg.com/", access="public Events Calendar REST API", terms_url="https://prinzipal-kreuzberg.com/robots.txt", attribution="Prinzipal Kreuzberg"),
    Policy("ra", "needs_permission", ("ra.co",), name="Resident Advisor", homepage="https://ra.co/", access="undocumented GraphQL endpoint", terms_url="https://ra.co/terms", attribution="Resident Advisor"),
    Policy("rausgegangen", "stop", ("rausgegangen.de",), name="Rausgegangen", homepage="https://rausgegangen.de/", access="sitemap + JSON-LD", terms_url="https://rausgegangen.de/conditions/", attribution="Rausgegangen"),
    Policy("tip_berlin", "needs_permission", ("tip-berlin.de",), name="tip Berlin", homepage="https://www.tip-berlin.de/", access="sitemap + JSON-LD", terms_url="https://cine-marketing-gmbh.de/datenlieferung-service.html", attribution="tip Berlin"),
    Policy("livegigs", "needs_permission", ("livegigs.de",), name="livegigs.de", homepage="https://www.livegigs.de/", access="JSON-LD in listing pages", terms_url="https://www.livegigs.de/agb", attribution="livegigs.de"),
    Policy("eventbrite", "stop", ("eventbrite.de", "eventbrite.com", "eventbrite.nl", "eventbrite.co.uk"), name="Eventbrite", homepage="https://www.eventbrite.de/", access="listing-page data blob", terms_url="https://www.eventbrite.com/help/en-us/articles/251210/eventbrite-terms-of-service/", attribution="Eventbrite"),
    Policy("comedy_in_english", "needs_permission", ("comedyinenglish.de",), name="Comedy in English", homepage="https://comedyinenglish.de/", access="public Events Calendar REST API", terms_url="https://comedyinenglish.de/robots.txt", attribution="Comedy in English"),
    Policy("comedy_cafe", "needs_permission", ("comedycafeberlin.com",), name="Comedy Café Berlin", homepage="https://www.comedycafeberlin.com/", access="public Events Calendar REST API", terms_url="https://www.comedycafeberlin.com/robots.txt", attribution="Comedy Café Berlin"),
)


@dataclass(frozen=True)
class Settings:
    """One run over one city."""

    as_of: str  # a date, yyyy-MM-dd
    city: str = "berlin"
    zone: str = "Europe/Berlin"
    window_days: int = 30
    policies: tuple[Policy, ...] = ()
    permitted: tuple[str, ...] = ()  # sources allowed by hand although they need permission
    denied: tuple[str, ...] = field(default=())
    stock_photos: bool = False
    placeholders: str | None = None  # loremflickr or picsum

    def permits(self, slug: str) -> bool:
        return slug in self.permitted or any(p.slug == slug and p.status == "active" for p in self.policies)

    def sources(self, only: list[str] | None = None, cheap: bool = False) -> list[str]:
        """The city's sources of a run, in their order: permitted, named by ``only`` if given, cheap ones in a run between."""
        return [s for s in CITY_SOURCES.get(self.city, []) if (not only or s in only) and self.permits(s) and (not cheap or s in CHEAP)]


def from_environment(as_of: str, environ: dict[str, str], **fields) -> Settings:
    """Settings with the shipped policies and the sources that ``KALENDS_PERMITTED`` names (comma-separated) permitted."""
    named = (x.strip() for x in environ.get("KALENDS_PERMITTED", "").split(","))
    switch = environ.get("KALENDS_STOCK_PHOTOS", "").strip().lower() in ("1", "true", "yes")
    return Settings(as_of, **{"policies": POLICIES, "permitted": tuple(x for x in named if x), "stock_photos": switch, **fields})
