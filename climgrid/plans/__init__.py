"""End-to-end plans: refinement, preparation and cloud radiation."""
