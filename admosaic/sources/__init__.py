"""Sources: landed response pages, the tabular source, the registry and the sink."""

from .amazon import AMAZON
from .apple import APPLE
from .base import Source
from .booking import BOOKING
from .linkedin import LINKEDIN
from .meta import META
from .microsoft import MICROSOFT
from .pinterest import PINTEREST
from .snapchat import SNAPCHAT
from .tiktok import TIKTOK
from .x import X

#: Sources that arrive as pages. A new source is one entry here and one registry entry.
PAGE_SOURCES: dict[str, Source] = {
    s.name: s
    for s in (AMAZON, APPLE, BOOKING, LINKEDIN, META, MICROSOFT, PINTEREST, SNAPCHAT, TIKTOK, X)
}
