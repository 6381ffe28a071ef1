"""marquee package of the listing analytics engine."""
