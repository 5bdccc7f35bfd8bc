"""Writers; the only actions of the library besides size checks."""
