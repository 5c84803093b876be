"""Query plans: presets, search, guarded SQL, run state, and the registered queries."""
