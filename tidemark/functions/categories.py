"""What a text is about, by tables of patterns: the category with most matches, all that match, or the first in order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, may_match

# Intents of property advertisers, trades of home services, sectors of businesses, each in its order of precedence.
INTENTS = {
    "seller_leads": [
        r"\bsell(ing)?\s*(your|my|a)?\s*home\b", r"\bselling\s*your\s*(house|property)\b", r"\bhome\s*valuation\b",
        r"\bwhat\'?s?\s*(your|my)\s*home\s*worth\b", r"\bfree\s*(home\s*)?valuation\b", r"\bmarket\s*value\b", r"\blist(ing)?\s*(your|my)\s*home\b",
        r"\bthinking\s*(of|about)\s*selling\b", r"\bready\s*to\s*sell\b", r"\bget\s*(top|highest)\s*(dollar|price)\b",
        r"\bcash\s*(offer|buyer|for\s*your)\b", r"\bwe\s*buy\s*houses\b", r"\bsell\s*fast\b", r"\binstant\s*offer\b", r"\bibuyer\b",
        r"\bhouse\s*offer\b", r"\bbuy\s*your\s*house\b",
    ],
    "buyer_leads": [
        r"\bbuy(ing)?\s*(a|your)?\s*(new\s*)?(home|house)\b", r"\bhome\s*buyer\b", r"\bfirst.?time\s*buyer\b",
        r"\bfind(ing)?\s*(your|a|my)\s*(dream\s*)?(home|house)\b", r"\bsearch(ing)?\s*(for)?\s*(homes|houses|properties)\b", r"\bdream\s*home\b",
        r"\bhouse\s*hunting\b", r"\bnew\s*listing\b", r"\bjust\s*listed\b", r"\bopen\s*house\b", r"\bprice\s*reduced\b", r"\bhome\s*for\s*sale\b",
        r"\bstart\s*(your)?\s*search\b", r"\bready\s*to\s*buy\b",
    ],
    "rental": [
        r"\b(for\s*)?rent(al|ing|er)?\b", r"\blease\b", r"\bapartment\b", r"\btenant\b", r"\blandlord\b", r"\brenter\b", r"\bleasing\s*now\b",
        r"\bavailable\s*(for\s*)?rent\b", r"\bmonthly\s*rent\b", r"\bno\s*deposit\b", r"\bpet\s*friendly\b", r"\bstudio\b", r"\b1\s*bed(room)?\b",
        r"\b2\s*bed(room)?\b",
    ],
    "agent_recruiting": [
        r"\bjoin\s*(our|my|the)\s*team\b", r"\breal\s*estate\s*career\b", r"\bbecome\s*(an?\s*)?(agent|realtor)\b", r"\brecruit(ing|ment)?\b",
        r"\bhiring\s*(agents|realtors)\b", r"\bbrokerage\b", r"\bnow\s*hiring\b", r"\bcommission\s*split\b", r"\bagent\s*opportunity\b",
        r"\bbuilding\s*a\s*career\b", r"\bserious\s*about\s*building\s*a\s*career\b", r"\bpeople\s*who\s*thrive\b",
    ],
    "branding": [
        r"\bleave\s*a\s*(facebook\s*)?review\b", r"\btestimoni(al|es)\b", r"\b(your|my)\s*experience\s*with\s*me\b", r"\bclient\s*review\b",
        r"\b5.?star\s*review\b",
    ],
    "investor": [
        r"\binvest(or|ment|ing)?\s*(property|properties|opportunity)?\b", r"\broi\b", r"\bcash\s*flow\b", r"\bflip(ping)?\b", r"\bwholesale\b",
        r"\brental\s*income\b", r"\bpassive\s*income\b", r"\bmulti.?family\b", r"\bfix\s*(and|&)\s*flip\b", r"\bbuy\s*(and|&)\s*hold\b",
        r"\bcap\s*rate\b",
    ],
    "mortgage": [
        r"\bmortgage\b", r"\b(home\s*)?loan\b", r"\bfinancing\b", r"\bpre.?approv(al|ed)\b", r"\binterest\s*rate\b", r"\brefinance\b", r"\brefi\b",
        r"\bdown\s*payment\b", r"\blender\b", r"\bfha\b", r"\bva\s*loan\b", r"\bconventional\s*loan\b",
    ],
}
TRADES = {
    "roofing": [
        r"\broof(ing|er)?\b", r"\bshingle\b", r"\bgutter\b", r"\broof\s*repair\b", r"\broof\s*replacement\b", r"\broof\s*inspection\b",
        r"\bstorm\s*damage\b", r"\bleak(ing|s)?\s*roof\b",
    ],
    "hvac": [
        r"\bhvac\b", r"\bheating\b", r"\bcooling\b", r"\bair\s*condition(ing|er)?\b", r"\bfurnace\b", r"\ba/?c\s*(repair|service|install)\b",
        r"\bduct\s*(work|cleaning)\b", r"\bthermostat\b", r"\bheat\s*pump\b",
    ],
    "plumbing": [
        r"\bplumb(ing|er)\b", r"\bdrain\b", r"\bpipe\b", r"\bwater\s*heater\b", r"\bsewer\b", r"\bclog(ged)?\b", r"\bleaky?\s*(faucet|pipe)\b",
        r"\btoilet\b", r"\bfaucet\b", r"\bgarbage\s*disposal\b",
    ],
    "electrical": [
        r"\belectric(al|ian)?\b", r"\bwiring\b", r"\bcircuit\b", r"\bpanel\s*(upgrade|replacement)?\b", r"\boutlet\b",
        r"\blighting\s*(install|repair)\b", r"\bgenerator\b", r"\bsolar\s*(panel|install)\b",
    ],
    "pest_control": [
        r"\bpest\s*(control)?\b", r"\bexterminat(or|ing|ion)\b", r"\btermite\b", r"\bbug\b", r"\binsect\b", r"\brodent\b", r"\bmice\b", r"\brat\b",
        r"\bbed\s*bug\b", r"\bcockroach\b", r"\bant\s*(control|removal)\b",
    ],
    "cleaning": [
        r"\bclean(ing|er|s)?\b", r"\bmaid\b", r"\bjanitorial\b", r"\bpressure\s*wash\b", r"\bpower\s*wash\b", r"\bhouse\s*cleaning\b",
        r"\bdeep\s*clean\b", r"\bcarpet\s*clean\b", r"\bwindow\s*clean\b",
    ],
    "landscaping": [
        r"\blandscap(ing|er|e)\b", r"\blawn\s*(care|mowing|service)\b", r"\btree\s*(service|removal|trim)\b", r"\bgarden(ing|er)?\b",
        r"\birrigation\b", r"\bsprinkler\b", r"\bsod\b", r"\bmulch\b", r"\bhedge\b", r"\byard\s*(work|clean)\b",
    ],
    "painting": [
        r"\bpaint(ing|er)\b", r"\bcoating\b", r"\binterior\s*paint\b", r"\bexterior\s*paint\b", r"\bhouse\s*paint\b", r"\bstain(ing)?\b",
    ],
    "general_contractor": [
        r"\bcontractor\b", r"\bremodel(ing|er)?\b", r"\brenovation\b", r"\bconstruction\b", r"\bhandyman\b", r"\bhome\s*improvement\b",
        r"\bkitchen\s*(remodel|renovation)\b", r"\bbathroom\s*(remodel|renovation)\b", r"\bbasement\s*(finish|remodel)\b", r"\baddition\b",
    ],
    "appliance_repair": [
        r"\bappliance\s*(repair|service)\b", r"\bwasher\s*(repair)?\b", r"\bdryer\s*(repair)?\b", r"\brefrigerator\s*(repair)?\b",
        r"\bdishwasher\s*(repair)?\b", r"\boven\s*(repair)?\b", r"\bstove\s*(repair)?\b",
    ],
    "flooring": [
        r"\bfloor(ing|s)?\b", r"\bhardwood\b", r"\btile\b", r"\bcarpet\s*(install)?\b", r"\blaminate\b", r"\bvinyl\s*(plank)?\b",
    ],
    "fencing": [
        r"\bfenc(e|ing)\b", r"\bgate\s*(install|repair)?\b",
    ],
    "moving": [
        r"\bmov(ing|er)\b", r"\brelocation\b", r"\bpacking\s*service\b", r"\bstorage\b", r"\bjunk\s*removal\b", r"\bhauling\b",
    ],
    "garage_door": [
        r"\bgarage\s*door\b", r"\boverhead\s*door\b",
    ],
    "pool": [
        r"\bpool\s*(service|cleaning|repair|build)\b", r"\bswimming\s*pool\b", r"\bhot\s*tub\b", r"\bspa\s*service\b",
    ],
    "locksmith": [
        r"\blocksmith\b", r"\block(s)?\s*(repair|change|install)\b", r"\bkey\s*(cut|copy|duplicate)\b",
    ],
    "glass": [
        r"\bglass\s*(repair|replacement)\b", r"\bwindow\s*(repair|replacement|install)\b", r"\bauto\s*glass\b", r"\bwindshield\b",
    ],
    "windows_doors": [
        r"\bwindow(s)?\b", r"\bandersen\s*windows\b", r"\bdoor(s)?\s*(install|replace)?\b", r"\bpatio\s*door\b", r"\bsliding\s*door\b",
        r"\bwindow\s*dealer\b",
    ],
    "lighting": [
        r"\blighting\b", r"\bpermanent\s*light(s|ing)?\b", r"\bholiday\s*light(s|ing)?\b", r"\boutdoor\s*light(s|ing)?\b",
        r"\blandscape\s*light(s|ing)?\b",
    ],
}
SECTORS = {
    "Real Estate": [
        r"\brealt[yo]r?\b", r"\breal\s*estate\b", r"\bmortgage\b", r"\btitle\b", r"\bescrow\b", r"\bproperty\b",
    ],
    "Legal Services": [
        r"\battorney\b", r"\blaw\s*firm\b", r"\blegal\b", r"\blawyer\b", r"\b,\s*pc\b", r"\besq\b",
    ],
    "Healthcare": [
        r"\bmedical\b", r"\bdental\b", r"\bdentist\b", r"\bclinic\b", r"\bdoctor\b", r"\bdr\.\s", r"\btherapy\b", r"\bhealth\b",
    ],
    "Finance & Accounting": [
        r"\bcpa\b", r"\baccountant\b", r"\bbookkeep\b", r"\btax\s*(prep|service)?\b", r"\bfinancial\b",
    ],
    "Insurance": [
        r"\binsurance\b", r"\ballstate\b", r"\bstate\s*farm\b",
    ],
    "Education": [
        r"\bschool\b", r"\bacademy\b", r"\buniversity\b", r"\bcollege\b", r"\btraining\b", r"\bcdl\b",
    ],
    "Home Services": [
        r"\broofing\b", r"\bplumbing\b", r"\bhvac\b", r"\belectrical\b", r"\bpest\b", r"\bexterminat\b", r"\bcleaning\b", r"\bjunk\b",
        r"\blandscap\b", r"\bpainting\b", r"\bcoating\b", r"\brepair\b",
    ],
    "Auto & Sales": [
        r"\bauto\s*(sales|deal)?\b", r"\bcar\s*(sales|dealer)?\b", r"\btrailer\s*sales\b", r"\bdealership\b",
    ],
    "Beauty & Wellness": [
        r"\bsalon\b", r"\bspa\b", r"\bbeauty\b", r"\baesthetics?\b", r"\bhair\b", r"\bnail\b", r"\bbarber\b",
    ],
    "Construction & Excavation": [
        r"\bexcavat\b", r"\bconstructi?o?n?\b", r"\bdemolition\b", r"\bcontractor\b", r"\bbuilder\b", r"\bsite\s*work\b",
    ],
    "Furniture & Retail": [
        r"\bfurniture\b", r"\bmattress\b", r"\bhome\s*goods\b", r"\bappliance\b",
    ],
    "Food & Restaurant": [
        r"\brestaurant\b", r"\bcatering\b", r"\bcafe\b", r"\bfood\b", r"\bdining\b", r"\bpizza\b",
    ],
    "Fitness & Gym": [
        r"\bfitness\b", r"\bgym\b", r"\bpersonal\s*train\b", r"\bworkout\b", r"\bcrossfit\b",
    ],
    "Technology & Software": [
        r"\bsoftware\b", r"\btech\b", r"\bsaas\b", r"\bapp\b", r"\bplatform\b", r"\bdigital\b",
    ],
    "Professional Services": [
        r"\bmarketing\b", r"\bconsulting\b", r"\bphotograph\b", r"\bdesign\b", r"\bagency\b", r"\bstudio\b", r"\bstaffing\b", r"\brecruit\b",
    ],
    "Entertainment & Media": [
        r"\bmedia\b", r"\bproduction\b", r"\bentertainment\b", r"\bvideo\b", r"\bcontent\b",
    ],
    "Nonprofit & Community": [
        r"\bnonprofit\b", r"\bcharity\b", r"\bchurch\b", r"\bfoundation\b", r"\bcommunity\b",
    ],
}

#: Case and word boundaries as Unicode has them.
FLAGS = "(?iU)"


def _low(text: Column) -> Column:
    """Lower case, with the letters beyond ASCII that a pattern's ASCII letters match as those letters."""
    for other, letter in (("ı", "i"), ("İ", "i"), ("ſ", "s"), ("\u212a", "k")):
        text = F.replace(text, F.lit(other), F.lit(letter))
    return F.lower(text)


def match_counts(text: Column, table: dict[str, list[str]]) -> Column:
    """An array of (n, category), in the table's order: how often the category's patterns match, each pattern's matches on their own.

    A pattern is tried only where the words occur that all its matches have: a text seldom has more than a few of them.
    """
    def count(t: Column, low: Column, patterns: list[str]) -> Column:
        total = F.lit(0)
        for p in patterns:
            total = total + F.when(may_match(low, p), F.regexp_count(t, F.lit(FLAGS + p))).otherwise(0)
        return total

    counts = lambda t, low: F.array(*(F.struct(count(t, low, patterns).alias("n"), F.lit(name).alias("category")) for name, patterns in table.items()))
    return let(text, lambda t: let(_low(t), lambda low: counts(t, low)))


def first_matched(text: Column, table: dict[str, list[str]]) -> Column:
    """The first category in order of which any pattern matches; null if none does."""
    def hit(t: Column, low: Column, patterns: list[str]) -> Column:
        out = F.lit(False)
        for p in patterns:
            out = out | (may_match(low, p) & t.rlike(FLAGS + p))
        return out

    return let(text, lambda t: let(_low(t), lambda low: F.coalesce(*(F.when(hit(t, low, patterns), F.lit(name)) for name, patterns in table.items()))))
