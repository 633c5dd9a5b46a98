"""Writers. Every one is a plain DataFrame write; order columns are added where a layout needs them."""
