"""What can go wrong with records, as exceptions of one family."""


class RecordError(Exception):
    """Any trouble with captured records."""


class InputError(RecordError):
    """An input that can't be read."""


class LayoutError(RecordError):
    """Records whose layout isn't one: keys that hold data, too many paths."""


class SettingError(RecordError):
    """Settings that contradict each other."""
