"""Raw sources, Bronze loads and layered tables."""
